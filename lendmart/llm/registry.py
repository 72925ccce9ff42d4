"""Registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lendmart.llm import (
    ann, bpe, chat_quotes, line_dedup, minhash_near, packing, period_runs, phrases, pseudonyms, quality_rules,
    secret_scan, simhash_near, warc_revisits,
)

TOKENIZER = "byte_bpe_50k.json"
#: Links pseudonyms across documents; a deployment passes a secret of its own.
PSEUDONYM_KEY = b"key for the registered queries"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spans(column: str):
    return F.array_join(F.transform(
        column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")


def op1_secret_scan(spark, sf_dir):
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_spans("base"), 256).alias("base_sha256"), _spans("spans").alias("spans"),
    )


def op2_simhash_near_dedup(spark, sf_dir):
    groups = simhash_near.near_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op3_line_dedup(spark, sf_dir):
    kept = line_dedup.without_repeats(
        table(spark, sf_dir, "documents").select("doc_id", "text"), count_col="n_removed", short_lines=True
    )
    return kept.select("doc_id", "n_removed", "text")


def op4_bpe(spark, sf_dir):
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return coded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def crawl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web records from ``pages``: each page once in full and revisited on the two days
    after; of every fifth page the second revisit carries another tag."""
    pages = table(spark, sf_dir, "pages")
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    header = lambda *pairs: F.create_map(*[F.lit(x) if isinstance(x, str) else x for p in pairs for x in p])
    time = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60)
    stamp = lambda day: F.concat(F.lit(f"day {day} of page "), F.col("page_id").cast("string"))

    def record(number, at, kind, status, headers, payload):
        return F.struct(
            (F.col("page_id") * 3 + number).alias("record_id"), "url", at.alias("captured_at"),
            F.lit(kind).alias("kind"), F.lit(status).alias("status"), headers.alias("headers"), payload.alias("payload"),
        )

    other = F.when(F.col("page_id") % 5 == 0, F.lit('"another"')).otherwise(F.concat(F.lit("W/"), tag))
    none = F.lit(None).cast("string")
    records = F.array(
        record(0, time, "response", 200, header(
            ("Content-Type", "text/html"), ("ETag", tag), ("Date", stamp(0)), ("Server", "archive"),
        ), F.col("html")),
        record(1, time + F.expr("INTERVAL '1' DAY"), "revisit", 304, header(
            ("ETag", tag), ("Date", stamp(1)), ("Content-Length", "0"),
        ), none),
        record(2, time + F.expr("INTERVAL '2' DAY"), "revisit", 304, header(
            ("ETag", other), ("Date", stamp(2)), ("Cache-Control", "max-age=60"),
        ), none),
    )
    return pages.select(F.explode(records).alias("r")).select("r.*")


def op5_warc_revisits(spark, sf_dir):
    resolved = warc_revisits.resolve_revisits(crawl_records(spark, sf_dir))
    headers = F.array_join(F.transform(
        F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e["key"], e["value"])
    ), ";")
    return resolved.select(
        "record_id", "url_key", "verdict", "ref_id", "status", headers.alias("headers"),
        F.md5("payload").alias("payload_md5"), F.length("payload").cast("long").alias("payload_chars"),
    )


def op6_ann(spark, sf_dir):
    found = ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)
    return found.select("query_id", "rank", "vec_id", "score")


def op7_pii(spark, sf_dir):
    done = pseudonyms.pseudonymised(
        table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY, found_col="found"
    )
    count = lambda *kinds: F.size(F.filter("found", lambda f: f["kind"].isin(*kinds))).cast("long")
    return done.select(
        "doc_id", F.size("found").cast("long").alias("n_found"), count("mail").alias("n_mail"),
        count("telephone").alias("n_telephone"), count("machine").alias("n_machine"),
        count("card", "account", "social").alias("n_number"), count("date").alias("n_date"), "text",
    )


def quoting_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as mail: every message quotes the one before it, and that one's
    quotation of its own predecessor one level deeper."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", F.col("turn").alias("msg_id"), "role", F.coalesce("text", F.lit("")).alias("text")
    )
    back = lambda n: turns.select(
        "conv_id", (F.col("msg_id") + n).alias("msg_id"), F.col("text").alias(f"back{n}")
    )
    marked = lambda c, mark: F.concat(F.lit(mark), F.regexp_replace(c, "\n", f"\n{mark}"))
    both = turns.join(back(1), ["conv_id", "msg_id"], "left").join(back(2), ["conv_id", "msg_id"], "left")
    return both.select("conv_id", "msg_id", "role", F.concat_ws(
        "\n", marked(F.col("back2"), ">> "), marked(F.col("back1"), "> "), "text"
    ).alias("text"))


def op8_chat_quotes(spark, sf_dir):
    threads = chat_quotes.conversations(quoting_messages(spark, sf_dir))
    return threads.select(
        "conv_id", "msg_id", F.col("parent").alias("parent_id"), "depth", "role",
        F.md5(chat_quotes.normalised(F.col("text"))).alias("text_md5"),
    )


def op9_quality_rules(spark, sf_dir):
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


#: Phrases reported of each language.
TOP_PHRASES = 2000


def op11_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"), TOP_PHRASES)


def op12_minhash_near_dedup(spark, sf_dir):
    near = minhash_near.near_sets(table(spark, sf_dir, "documents"))
    return near.select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"),
        (F.col("doc_id") == F.col("component")).alias("kept"),
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of every tenth document by a hash of its id, the words from a place
    on repeat the first of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    split = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w")).select(
        "doc_id", "text", "w", F.size("w").alias("n"), F.floor(F.col("h") / 10).alias("g")
    )
    first = split.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = F.expr("1 + (n - a) DIV (3 + g % 8)")
    word = lambda i: F.element_at(
        "w", (F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")) + 1).cast("int")
    )
    made = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1), word), " ")
    return first.withColumn("p", period).select(
        "doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text")
    )


def op13_period_runs(spark, sf_dir):
    found = period_runs.periodic_runs(planted_periods(table(spark, sf_dir, "documents")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")
    )), "")
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")
    )))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "top.start", (-F.col("top.less")).alias("length"), "top.period",
        F.expr("(1000 * -top.less) DIV top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_simhash_near_dedup, op3_line_dedup, op4_bpe, op5_warc_revisits,
        op6_ann, op7_pii, op8_chat_quotes, op9_quality_rules, op10_packing, op11_collocations,
        op12_minhash_near_dedup, op13_period_runs,
    )
}

ORACLE_SQL = {
    "op5_warc_revisits": r"""
WITH p AS (
  SELECT page_id, html, md5(html) AS tag,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(
      url, '^\s*(?:https?://)?(?:[^/?#@]*@)?([^/?#]+)', 1, 'i')), '\s+$', ''), '^www\.|:(80|443)?$', ''), ':(80|443)?$', '') AS host,
    regexp_replace(regexp_replace(regexp_extract(
      url, '^\s*(?:https?://)?(?:[^/?#@]*@)?[^/?#]+([^?#]*)', 1, 'i'), '/+$', ''), '^/+', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(
      url, '\?([^#]*)', 1), '&'), lambda x: x <> '')), '&') AS query
  FROM pages),
k AS (SELECT *, host || '/' || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url_key FROM p),
r AS (
  SELECT page_id * 3 + n AS record_id, url_key, page_id * 60 + n * 86400 AS time_s, n, page_id, html, tag,
    CASE WHEN n = 2 AND page_id % 5 = 0 THEN 'another' ELSE tag END AS own_tag
  FROM k, (VALUES (0), (1), (2)) AS v(n)),
a AS (
  SELECT *, last_value(CASE WHEN n = 0 THEN record_id END IGNORE NULLS) OVER (
    PARTITION BY url_key ORDER BY time_s, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ref_id
  FROM r),
j AS (
  SELECT a.*, f.html AS whole, f.tag AS full_tag, a.own_tag = f.tag AS good
  FROM a LEFT JOIN k f ON a.ref_id = f.page_id * 3 WHERE a.n > 0)
SELECT record_id, url_key,
  CASE WHEN ref_id IS NULL THEN 'unresolved' WHEN good THEN 'resolved' ELSE 'changed' END AS verdict, ref_id,
  CASE WHEN good THEN 200 ELSE 304 END AS status,
  CASE WHEN n = 1 AND good THEN 'content-type=text/html;date=day 1 of page ' || page_id || ';etag="' || tag || '";server=archive'
       WHEN n = 1 THEN 'content-length=0;date=day 1 of page ' || page_id || ';etag="' || tag || '"'
       WHEN good THEN 'cache-control=max-age=60;content-type=text/html;date=day 2 of page ' || page_id || ';etag=W/"' || tag || '";server=archive'
       ELSE 'cache-control=max-age=60;date=day 2 of page ' || page_id || ';etag=' ||
         CASE WHEN own_tag = 'another' THEN '"another"' ELSE 'W/"' || tag || '"' END END AS headers,
  CASE WHEN good THEN md5(whole) END AS payload_md5, CASE WHEN good THEN length(whole) END AS payload_chars
FROM j
""",
    "op8_chat_quotes": r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, trim(regexp_replace(lower(coalesce(text, '')), '\s+', ' ', 'g')) AS norm FROM conversations),
o AS (SELECT conv_id, norm, min(turn) AS first FROM m WHERE norm <> '' GROUP BY ALL),
l AS (
  SELECT m.conv_id, m.turn, m.role, m.norm, o.first AS parent FROM m
  LEFT JOIN m b ON b.conv_id = m.conv_id AND b.turn = m.turn - 1
  LEFT JOIN o ON o.conv_id = m.conv_id AND o.norm = b.norm),
d AS (
  SELECT conv_id, turn, 0::BIGINT AS depth FROM l WHERE parent IS NULL
  UNION ALL
  SELECT l.conv_id, l.turn, d.depth + 1 FROM l JOIN d ON d.conv_id = l.conv_id AND d.turn = l.parent)
SELECT l.conv_id, l.turn AS msg_id, l.parent AS parent_id, d.depth, l.role, md5(l.norm) AS text_md5
FROM l JOIN d USING (conv_id, turn)
""",
}
