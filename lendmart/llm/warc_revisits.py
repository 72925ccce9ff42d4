"""Resolution of not-modified revisit records.

A revisit is matched to the latest earlier full response of the same canonical URL (an as-of
join), its validators are checked against that response, and the headers that a not-modified
answer may update are merged into the stored ones.

The as-of join works on narrow rows in time slices: the last response of every URL and slice
is aggregated, one window over those few rows carries it to later slices, and a window
inside a slice finds closer ones. A URL with a third of all records so spreads over its
slices. Payloads join last, by record id.

Records: record_id, url, captured_at, kind ('response' or 'revisit'), status, headers (map),
payload.

Defined results: a revisit without earlier response is 'unresolved', one whose validators
disagree 'changed', one without a validator in common 'unverified'; the three have no
payload, and the last two name the response that was found. At equal times the smaller
record id is the earlier record. Null URLs and times match nothing. Records are told apart
by all they hold, so records that share an id or have none are each resolved on their own,
and a repeated revisit gives a row each time. Header names are compared
in lower case; of a name given twice in different case, the value last in order counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICE_SECONDS = 3600

# Headers that a not-modified answer never updates.
KEPT_HEADERS = (
    "connection", "content-encoding", "content-length", "content-range", "content-type",
    "keep-alive", "proxy-authenticate", "proxy-authentication-info", "proxy-authorization",
    "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Host without ``www.``, user and default port in lower case, path, query parts in
    order; no scheme and no fragment. Null if there is no host."""
    whole = r"^\s*(?i:(https?)://)?(?:[^/?#@]*@)?([^/?#]+)([^?#]*)(?:\?([^#]*))?"
    part = lambda k: F.regexp_extract(url, whole, k)
    host = F.regexp_replace(F.regexp_replace(F.lower(part(2)), r"\s+$", ""), r"^www\.|:(80|443)?$", "")
    host = F.regexp_replace(host, r":(80|443)?$", "")
    path = F.regexp_replace(F.trim(part(3)), r"/+$", "")
    query = F.array_join(F.array_sort(F.filter(F.split(F.trim(part(4)), "&"), lambda p: p != "")), "&")
    return F.when(
        host != "", F.concat(host, F.lit("/"), F.regexp_replace(path, "^/+", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    )


def _lower_names(headers: Column) -> Column:
    """The map with names in lower case; of equal names the last entry counts."""
    entries = F.transform(
        F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>")),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    last = F.filter(entries, lambda e, i: ~F.exists(
        F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda later: later["key"] == e["key"]
    ))
    return F.map_from_entries(F.array_sort(last))


def resolve_revisits(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """(record_id, url_key, captured_at, verdict, ref_id, status, headers, payload) of every
    revisit."""
    base = records.select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), "captured_at", "status",
        _lower_names(F.col("headers")).alias("headers"), "payload", "kind",
    )
    base = base.withColumn("row_key", F.xxhash64(
        "record_id", "url_key", "captured_at", "status", F.map_entries("headers"), "payload", "kind",
        *[F.col(c).isNull() for c in ("record_id", "url_key", "captured_at", "status", "payload")],
    ))
    is_full = (F.col("kind") == "response") & (F.col("status") == 200)
    is_revisit = F.col("kind") == "revisit"
    slot = F.floor(F.unix_micros(F.col("captured_at").cast("timestamp")) / F.lit(slice_seconds * 1_000_000))
    narrow = base.where((is_full | is_revisit) & F.col("url_key").isNotNull() & F.col("captured_at").isNotNull()).select(
        "url_key", slot.alias("slot"), "captured_at", "record_id", "row_key",
        F.when(is_full, F.col("row_key")).alias("full_key"),
    )
    inside = Window.partitionBy("url_key", "slot").orderBy("captured_at", "record_id", "row_key").rowsBetween(
        Window.unboundedPreceding, -1
    )
    close = narrow.withColumn("near_key", F.last("full_key", ignorenulls=True).over(inside))
    per_slot = narrow.groupBy("url_key", "slot").agg(F.max(F.when(
        F.col("full_key").isNotNull(), F.struct("captured_at", "record_id", "row_key")
    )).alias("latest"))
    earlier = Window.partitionBy("url_key").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slot.select(
        "url_key", "slot", F.last("latest.row_key", ignorenulls=True).over(earlier).alias("far_key")
    )
    found = close.where(F.col("full_key").isNull()).join(carried, ["url_key", "slot"]).select(
        F.col("row_key").alias("found_for"), F.coalesce("near_key", "far_key").alias("ref_key")
    ).where(F.col("ref_key").isNotNull()).dropDuplicates(["found_for"])  # equal rows find the same
    full = base.where(is_full).select(
        F.col("row_key").alias("ref_key"), F.col("record_id").alias("ref_id"), F.col("headers").alias("stored"),
        F.col("payload").alias("whole"),
    ).dropDuplicates(["ref_key"])
    revisits = base.where(is_revisit).drop("payload", "kind")
    matched = revisits.join(found, F.col("row_key") == F.col("found_for"), "left").drop("found_for").join(
        full, "ref_key", "left"
    )
    tag = lambda h: F.regexp_replace(F.try_element_at(h, F.lit("etag")), "^W/", "")
    stamp = lambda h: F.try_element_at(h, F.lit("last-modified"))
    digest = lambda h: F.try_element_at(h, F.lit("digest"))
    same = [f(F.col("headers")) == f(F.col("stored")) for f in (tag, stamp, digest)]
    agree = F.coalesce(*same)  # the strongest validator that both have decides
    verdict = (
        F.when(F.col("ref_key").isNull(), "unresolved").when(agree.isNull(), "unverified")
        .when(agree, "resolved").otherwise("changed")
    )
    newer = F.map_filter("headers", lambda name, _: ~name.isin(*KEPT_HEADERS))
    older = F.map_filter("stored", lambda name, _: ~F.array_contains(F.map_keys(newer), name))
    good = F.col("verdict") == "resolved"
    return matched.withColumn("verdict", verdict).select(
        "record_id", "url_key", "captured_at", "verdict", "ref_id",
        F.when(good, F.lit(200)).otherwise(F.col("status")).alias("status"),
        F.when(good, F.map_concat(older, newer)).otherwise(F.col("headers")).alias("headers"),
        F.when(good, F.col("whole")).alias("payload"),
    )
