"""Merges over DataFrames: insert-only, high-watermark delta and upsert.

Plain Parquet has no MERGE statement, so each merge is a join that returns the
new content (or only the new rows); ``sources.landing`` writes it. The large
target is only ever probed by the distinct keys of the small side: while those
are few, Spark broadcasts them and the target is scanned without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .joins import Hot, SHARE, hot_keys, spread_join


class AmbiguousMerge(ValueError):
    """Several delta rows for one target row."""


def _names(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _all_present(keys: list[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


# --- insert-only --------------------------------------------------------------
def new_rows(target: DataFrame, staging: DataFrame, key: str, ts: str = "created_at",
             hot: Hot = Hot()) -> DataFrame:
    """Distinct staging rows with a creation time whose key the target lacks.

    Rows with a NULL key match nothing and always count as new. Two differing
    staging rows with one new key are both new.
    """
    batch = staging.where(F.col(ts).isNotNull())
    wanted = batch.where(F.col(key).isNotNull()).select(key).distinct()
    known = target.select(key).join(wanted, key, "left_semi").distinct()
    others = [c for c in staging.columns if c != key] or [key]
    fresh = spread_join(
        batch.distinct(), known, key, "left_anti", others, hot._replace(nulls=True)
    )
    return fresh.select(staging.columns)


def insert_only_merge(target: DataFrame, staging: DataFrame, key: str,
                      ts: str = "created_at", hot: Hot = Hot()) -> DataFrame:
    """The target with the new staging rows; matched rows stay as they are."""
    return target.unionByName(new_rows(target, staging, key, ts, hot).select(target.columns))


# --- high-watermark delta --------------------------------------------------------
def high_watermark(target: DataFrame, ts: str = "created_at") -> datetime | None:
    """Newest time in the target, as one scalar."""
    return target.agg(F.max(ts).alias("newest")).first()["newest"]


def rows_after(src: DataFrame, mark: datetime, ts: str = "created_at",
               partition: str | None = None) -> DataFrame:
    """Rows later than ``mark``; late ones, ties and NULL times are left out.

    The mark is a literal, so it is pushed into the scan; on a source stored by
    day it also prunes the ``partition`` folders.
    """
    zoneless = isinstance(src.schema[ts].dataType, T.TimestampNTZType)
    # A Python time literal would pass through the zone of the Python process.
    literal = F.to_timestamp_ntz(F.lit(mark.isoformat(sep=" "))) if zoneless else F.lit(mark)
    later = src.where(F.col(ts) > literal)
    if partition and partition in src.columns:
        later = later.where(F.col(partition) >= F.lit(mark.date()))
    return later


def watermark_delta(src: DataFrame, target: DataFrame | None, ts: str = "created_at",
                    strict: bool = False) -> DataFrame:
    """Source rows newer than anything in the target.

    Without a target every row is taken. An empty target counts as a first run;
    with ``strict`` it takes nothing, as a comparison with NULL would.
    """
    if target is None:
        return src
    mark = high_watermark(target, ts)
    if mark is not None:
        return rows_after(src, mark, ts)
    return src.limit(0) if strict else src


# --- upsert --------------------------------------------------------------------
def assert_unique(delta: DataFrame, keys: str | list[str], null_safe: bool = False) -> DataFrame:
    """Returns the delta, or raises if two of its rows claim one target row, by a job of its
    own ahead of a merge; ``upsert`` has its own guard.

    Keys with a NULL match nothing, so they cannot clash unless ``null_safe``.
    """
    keys = _names(keys)
    checked = delta if null_safe else delta.where(_all_present(keys))
    clash = checked.groupBy(*keys).count().where(F.col("count") > 1).limit(1)
    if not clash.isEmpty():
        raise AmbiguousMerge(f"several delta rows share one key of {keys}")
    return delta


# Names of the encoded key: which parts are NULL, and the parts with NULLs filled in.
_FLAGS, _PART = "__nulls", "__key"
_GUARD = "several delta rows share one key of"


def _filler(dtype: T.DataType) -> Column:
    """Any fixed value of a type; the flags tell it from the same value in the data."""
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.BinaryType):
        return F.lit(b"")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(dtype)
    return F.lit(0).cast(dtype)


def _flags(keys: list[str]) -> Column:
    bits = F.lit(0)
    for k, key in enumerate(keys):
        bits = bits + F.when(F.col(key).isNull(), F.lit(1 << k)).otherwise(F.lit(0))
    return bits.cast("long")


def encoded(df: DataFrame, keys: list[str], null_safe: bool, side: int) -> DataFrame:
    """``df`` with its key as (flags, filled values) without NULLs, for a plain equi-join.

    If NULL matches nothing, rows with a NULL get a negative flag that the other ``side``
    (0 or 1) never has; it follows from the row, so such rows also spread over all tasks.
    """
    flags = _flags(keys)
    if not null_safe:
        own = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        apart = -1 - side - 2 * F.pmod(own, F.lit(1 << 30))
        flags = F.when(flags > 0, apart).otherwise(F.lit(0).cast("long"))
    filled = {f"{_PART}{k}": F.coalesce(F.col(key), _filler(df.schema[key].dataType)) for k, key in enumerate(keys)}
    return df.withColumns({_FLAGS: flags, **filled})


def hot_composite(df: DataFrame, keys: list[str], share: float = SHARE) -> Hot:
    """The frequent composite keys of ``df``, NULL patterns included, for a null-safe join."""
    on = [_FLAGS, *(f"{_PART}{k}" for k in range(len(keys)))]
    hashed = encoded(df.select(*keys), keys, True, 0).select(F.xxhash64(*on).alias("key"))
    return hot_keys(hashed, "key", share=share)["key"]


class _Probe(NamedTuple):
    """A delta prepared for meeting a target: its rows, its distinct keys, the join columns."""

    rows: DataFrame
    wanted: DataFrame
    on: list[str]


def _probe(delta: DataFrame, keys: list[str], null_safe: bool, guarded: bool) -> _Probe:
    """Deals a delta out by key once; its rows and its distinct keys are both read from that.

    The keys come from one aggregation that also counts their rows: a key that several rows
    claim ends the run. The digest in its message makes both readers ask for the same
    columns, so the dealing out, and what the delta is computed from, happens once.
    """
    on = [_FLAGS, *(f"{_PART}{k}" for k in range(len(keys)))]
    dealt = encoded(delta, keys, null_safe, 1).repartition(*on)
    if not guarded:
        return _Probe(dealt, dealt.select(*on).distinct(), on)
    every = F.xxhash64(*[F.col(f"`{c}`") for c in delta.columns])
    counted = dealt.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"), F.bit_xor(every).alias("__digest"))
    clash = (F.col("__rows") > 1) & (F.col(_FLAGS) >= 0)
    message = F.concat(F.lit(f"{_GUARD} {keys}, digest "), F.col("__digest").cast("string"))
    flags = F.when(clash, F.raise_error(message).cast("long")).otherwise(F.col(_FLAGS))
    return _Probe(dealt, counted.select(flags.alias(_FLAGS), *on[1:]), on)


def _meet(target: DataFrame, probe: _Probe, keys: list[str], null_safe: bool, how: str, hot: Hot) -> DataFrame:
    own = encoded(target, keys, null_safe, 0)
    rest = [c for c in target.columns if c not in keys] or keys
    return spread_join(own, probe.wanted, probe.on, how, rest, hot).select(target.columns)


def unmatched(target: DataFrame, delta: DataFrame, keys: str | list[str],
              null_safe: bool = False, hot: Hot = Hot()) -> DataFrame:
    """Target rows that no delta row replaces."""
    keys = _names(keys)
    return _meet(target, _probe(delta, keys, null_safe, False), keys, null_safe, "left_anti", hot)


def matched(target: DataFrame, delta: DataFrame, keys: str | list[str],
            null_safe: bool = False, hot: Hot = Hot()) -> DataFrame:
    """Target rows that a delta row replaces."""
    keys = _names(keys)
    return _meet(target, _probe(delta, keys, null_safe, False), keys, null_safe, "left_semi", hot)


def _probe_stored(delta: DataFrame, keys: list[str], null_safe: bool, guarded: bool) -> _Probe:
    """The same for a delta that is cheap to read again: only its keys are dealt out."""
    on = [_FLAGS, *(f"{_PART}{k}" for k in range(len(keys)))]
    rows = encoded(delta, keys, null_safe, 1)
    if not guarded:
        return _Probe(rows, rows.select(*on).distinct(), on)
    counted = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"))
    clash = (F.col("__rows") > 1) & (F.col(_FLAGS) >= 0)
    flags = F.when(clash, F.raise_error(F.lit(f"{_GUARD} {keys}")).cast("long")).otherwise(F.col(_FLAGS))
    return _Probe(rows, counted.select(flags.alias(_FLAGS), *on[1:]), on)


def upsert(target: DataFrame, delta: DataFrame, keys: str | list[str], null_safe: bool = False,
           checked: bool = False, hot: Hot = Hot(), stored: bool = False) -> DataFrame:
    """Target rows replaced by the delta rows of equal key, plus the other delta rows.

    The result raises when it is run if two delta rows claim one target row (see
    ``ambiguous``); ``checked`` is for callers that have made sure of it. Nothing runs while
    the plan is built, and the delta is computed once. A ``stored`` delta is read twice
    instead, and its rows are not shuffled.

    ``=`` never matches a NULL, so rows with a NULL in their key pile up;
    ``null_safe`` treats NULL as a value. ``hot`` (see ``hot_composite``) names keys that very
    many target rows share; others are left to adaptive execution.
    """
    keys = _names(keys)
    probe = (_probe_stored if stored else _probe)(delta, keys, null_safe, not checked)
    kept = _meet(target, probe, keys, null_safe, "left_anti", hot)
    return kept.unionByName(probe.rows.select(target.columns))


@contextmanager
def ambiguous() -> Iterator[None]:
    """Turns the guard's error, raised as a merge runs, into ``AmbiguousMerge``."""
    try:
        yield
    except PySparkException as error:
        if _GUARD in str(error):
            raise AmbiguousMerge(_GUARD + str(error).split(_GUARD, 1)[1].split("\n", 1)[0]) from error
        raise


# --- operational tables -----------------------------------------------------------
# Bits of the hash that settles ties of the order.
_TIE_BITS = 60


def insert_ignore(target: DataFrame, batch: DataFrame, unique_cols: str | list[str],
                  order_by: str | list[str]) -> DataFrame:
    """The target with those batch rows that break no unique key.

    Of several batch rows with one new key the first by ``order_by`` wins, of equal ones the
    one with the least hash. The least order of each key comes from an aggregate over
    numbers, which combines in a hash table before the shuffle, and the rows are found by it.
    NULL keys never conflict.
    """
    keys = _names(unique_cols)
    order = _names(order_by)
    columns = batch.columns
    rows = batch.where(_all_present(keys))
    tie = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(1 << _TIE_BITS))
    whole = isinstance(batch.schema[order[-1]].dataType, T.IntegralType)
    number = F.col(order[-1]).cast("decimal(20,0)") if whole else F.lit(0).cast("decimal(20,0)")
    ahead = F.lit(str(-(1 << 63) - 1)).cast("decimal(20,0)")  # NULL, before any number
    last = F.coalesce(number, ahead) * F.lit(str(1 << _TIE_BITS)).cast("decimal(19,0)")
    places = [F.col(c) for c in order[: -1 if whole else None]] + [(last + tie).cast("decimal(38,0)")]
    for place in places:  # one round for a single whole number
        rows = rows.withColumn("__place", place)
        least = rows.groupBy(*keys).agg(F.min("__place").alias("__least"))
        rows = rows.join(least, keys).where(F.col("__place").eqNullSafe(F.col("__least"))).select(columns)
    first = rows.distinct()  # what is left of a key is one row, repeated
    taken = target.select(*keys).distinct()
    fresh = first.join(taken, keys, "left_anti").unionByName(batch.where(~_all_present(keys)))
    return target.unionByName(fresh.select(target.columns))


def apply_stock_decrement(books: DataFrame, rents: DataFrame) -> DataFrame:
    """Books with their stock lowered by one per rental; it may fall below zero."""
    lent = rents.groupBy("book_id").agg(F.count(F.lit(1)).alias("_lent"))
    return (
        books.join(lent, "book_id", "left")
        .withColumn("stock", F.col("stock") - F.coalesce("_lent", F.lit(0)))
        .select(books.columns)
    )


def available_books(books: DataFrame) -> DataFrame:
    return books.where(F.col("stock") > 0).select("book_id", "stock")
