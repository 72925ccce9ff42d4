"""Finding and reloading the days that a watermark skipped.

A run that takes only rows newer than the newest it holds never sees rows that arrive late,
share the newest time, or have no time. Beside every watched table lies a small table of
digests per day (``<table>__digests``). It is kept up as days are written, so finding the
days that differ reads the source once and the table not at all; only those days are reloaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.digests import DIGEST, combined_digests, day_digests, differing_days
from ..operators.joins import hot_keys
from ..schemas import KEYS, LAYERS, TABLES, layer_name
from ..sources.landing import (
    DAY, ensure_layer, on_days, replace_days, stored, table_exists, within_days, write_partitioned,
)
from . import dimfact, preparation
from .layers import backfill_fact, note_days

MODELS = {"users": preparation.prep_users, "books": preparation.prep_books, "rents": preparation.prep_rents}


def digest_table(table: str) -> str:
    return f"{table}__digests"


def note_digests(spark: SparkSession, table: str, identity: list[str], days: set | None = None,
                 ts: str = "created_at") -> None:
    """Computes the digests of a stored table anew, for ``days`` or for all of it."""
    aside = digest_table(table)
    known = table_exists(spark, aside)
    whole = days is None or not known
    content = spark.table(table) if whole else spark.table(table).where(on_days(DAY, days))
    fresh = day_digests(content, identity, ts)
    if not whole:
        fresh = fresh.unionAll(spark.table(aside).where(~on_days("day", days)).select(*DIGEST))
    write_partitioned(fresh, aside, None)


def absorb_digests(spark: SparkSession, table: str, appended: DataFrame, identity: list[str],
                   ts: str = "created_at") -> None:
    """Adds an appended batch to the digests of a table, which is not read."""
    aside, batch = digest_table(table), day_digests(appended, identity, ts)
    if table_exists(spark, aside):
        batch = combined_digests(spark.table(aside), batch)
    write_partitioned(batch, aside, None)


def skipped_days(spark: SparkSession, source: DataFrame, table: str, identity: list[str],
                 ts: str = "created_at") -> DataFrame:
    """(day, source_rows, target_rows) of the days in which source and table differ.

    ``identity`` names the columns that tell rows apart, by default key and time in
    ``repair_table``: changes of other columns in place then do not count. A table without
    digests gets them first.
    """
    if not table_exists(spark, digest_table(table)):
        note_digests(spark, table, identity, None, ts)
    return differing_days(day_digests(source, identity, ts), spark.table(digest_table(table)))


def repair_table(spark: SparkSession, source: DataFrame, table: str, key: str, ts: str = "created_at",
                 identity: list[str] | None = None) -> set:
    """Reloads exactly the days of a stored table that differ from the source; returns them.

    One scan of the source gives the digests, a second reads the differing days, by ranges of
    ``ts`` that reach its files. A day that the source has no more is dropped.
    """
    identity = identity or [key, ts]
    days = {row["day"] for row in skipped_days(spark, source, table, identity, ts).select("day").collect()}
    if days:
        replace_days(source.where(within_days(ts, days)), table, days, ts)
        note_digests(spark, table, identity, days, ts)
    return days


def repair_layers(spark: SparkSession, sources: dict[str, DataFrame] | None = None,
                  layers: dict = LAYERS) -> dict[str, set]:
    """Repairs preparation, dimensions and fact; returns the reloaded days of each table.

    The marts owe the days of the fact until ``run_marts``. Days of rentals are joined anew
    with the dimensions as they now are, and rentals that waited for a user or book that came
    late are filled in.
    """
    names = {layer: layer_name(layer, layers) for layer in layers}
    if sources is None:
        sources = {name: spark.table(f"{names['warehouse']}.{name}") for name in TABLES}
    done = {}
    for name, model in MODELS.items():
        table = f"{names['preparation']}.prep_{name}"
        content = model({name: sources[name].select(TABLES[name].names)})
        done[f"prep_{name}"] = repair_table(spark, content, table, KEYS[name])
    for name in ("users", "books"):
        content = stored(spark, f"{names['preparation']}.prep_{name}")
        done[f"dim_{name}"] = repair_table(spark, content, f"{names['dimfact']}.dim_{name}", KEYS[name])

    marts = ensure_layer(spark, names["datamart"])
    days = done["prep_rents"]
    fact = f"{names['dimfact']}.fact_rents"
    if days:
        rents = stored(spark, f"{names['preparation']}.prep_rents").where(within_days("created_at", days))
        dims = {name: stored(spark, f"{names['dimfact']}.{name}") for name in ("dim_users", "dim_books")}
        again = dimfact.fact_rents({"prep_rents": rents, **dims}, hot_keys(rents, "user_id", "book_id"))
        note_days(spark, marts, days)
        replace_days(again, fact, days)
    filled = backfill_fact(spark, layers) if done["dim_users"] or done["dim_books"] else set()
    done["fact_rents"] = days | filled
    return done


def left_out(source: DataFrame, mark, ts: str = "created_at") -> DataFrame:
    """(late, tied, without_time): rows at most as new as ``mark``, the newest time a table
    holds, that a delta over it does not look at, whether the table holds them or not."""
    time = F.col(ts)
    limit = F.to_timestamp_ntz(F.lit(mark.isoformat(sep=" ")))
    return source.agg(
        F.count_if(time < limit).alias("late"), F.count_if(time == limit).alias("tied"),
        F.count_if(time.isNull()).alias("without_time"),
    )
