"""The scheduled jobs as functions: daily load, layered model run, metric feed."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import hot_keys
from ..operators.merge import rows_after
from ..operators.metrics import metric_snapshot, with_cards
from ..schemas import KEYS, LAYERS, METRIC_LABELS, TABLES, layer_name
from ..sources.landing import (
    append_metrics, append_new_rows, beside, drop_parts, drop_table, ensure_layer, load_staging, on_days, put_parts,
    replace_days, stored, stored_days, stored_watermark, table_exists, upsert_table, write_csv, write_partitioned,
)
from ..sources.readers import EmptySlice, daily_slice, normalize_ts
from . import datamart, dimfact, preparation

Extract = Callable[[str], DataFrame]

# Days that marts owe, and the notes of them that a mart has caught up with, in the marts'
# database. Both are only ever added to, note by note, so runs beside each other lose nothing.
OWED, SETTLED = "owed_days", "settled_days"

# Mart -> its merge key and the column it is stored by (None: not by day).
MARTS = {
    "dmart_user_book": (["user_id", "created_at_date"], "created_at_date"),
    "dmart_gender_book": (
        ["gender", "book_type", "genre", "created_at_date"], "created_at_date"),
    "dmart_book_gender": (["gender", "book_type", "genre"], None),
    "dmart_booktype_stock": (["book_type"], None),
}


def daily_load(spark: SparkSession, extract: Extract, day: date | str, landing: str,
               layers: dict = LAYERS, on_empty: str = "error", exact: bool = False,
               through_csv: bool = True) -> list[str]:
    """One day of each source table: slice, CSV, staging, insert-only merge.

    ``extract(name)`` returns a source table, ``landing`` is a shared folder for
    the CSV files. ``through_csv=False`` stages the slice directly; times are cut
    to seconds either way. Tables load independently: all that have rows are
    loaded, then empty slices raise ``EmptySlice`` with the tables' names unless
    ``on_empty="skip"``. Returns the tables that had rows.
    """
    database = ensure_layer(spark, layer_name("warehouse", layers))
    loaded, empty = [], []
    for name, schema in TABLES.items():
        batch = daily_slice(extract(name), day, exact=exact, on_empty="skip")
        if batch.isEmpty():
            empty.append(name)
            continue
        batch, staged = normalize_ts(batch.select(schema.names)), f"{database}.{name}_staging"
        if through_csv:
            path = f"{landing}/{name}/{day}"
            write_csv(batch, path)
            staging = load_staging(spark, path, schema, staged)
        else:
            typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
            write_partitioned(batch.select(typed), staged)
            staging = stored(spark, staged)
        append_new_rows(staging, f"{database}.{name}", KEYS[name])
        loaded.append(name)
    if empty and on_empty == "error":
        raise EmptySlice(f"no rows of {day} in {', '.join(empty)}")
    return loaded


def run_layers(spark: SparkSession, sources: dict[str, DataFrame] | None = None,
               layers: dict = LAYERS, rebuild: bool = False, strict: bool = False,
               recent_marts: bool = True) -> None:
    """Preparation, then dimensions and fact, then marts.

    ``sources`` default to the warehouse tables. The first six models take only
    rows newer than what they hold; marts are upserted, with NULL as a key value.
    ``rebuild`` replaces everything instead. ``strict`` loads nothing into a table
    that exists but is empty.

    The marts per day are computed anew for the days that they still owe, and the other
    two from the stored counts per day, so a daily run costs one day. Days are
    noted in a table before the fact changes; a mart crosses out the notes it read
    before it was computed, so a run that ended early, a backfill or a run beside it is
    caught up by the next run, and a mart that does not exist takes the whole fact.
    ``recent_marts=False`` computes all marts from the whole fact. Models that do not
    need each other run at once.
    """
    run_models(spark, sources, layers, rebuild, strict)
    run_marts(spark, layers, rebuild, recent_marts)


def run_models(spark: SparkSession, sources: dict[str, DataFrame] | None = None,
               layers: dict = LAYERS, rebuild: bool = False, strict: bool = False) -> None:
    """The first part of ``run_layers``: preparation, dimensions and fact."""
    names = {layer: layer_name(layer, layers) for layer in layers}
    for database in names.values():
        ensure_layer(spark, database)
    if sources is None:
        sources = {name: spark.table(f"{names['warehouse']}.{name}") for name in TABLES}

    prep, dimfact_db = names["preparation"], names["dimfact"]

    def prepare(name: str, model: Callable[[dict], DataFrame]) -> None:
        table = f"{prep}.prep_{name}"
        source = _newer(spark, sources[name], table, rebuild, strict)
        delta = model({name: source.select(TABLES[name].names)})
        _publish(delta, table, [KEYS[name]], "created_at", rebuild)

    def describe(name: str, model: Callable[[dict], DataFrame]) -> None:
        table = f"{dimfact_db}.dim_{name}"
        source = _newer(spark, spark.table(f"{prep}.prep_{name}"), table, rebuild, strict)
        delta = model({f"prep_{name}": source.drop("created_date")})
        _publish(delta, table, [KEYS[name]], "created_at", rebuild)

    _side_by_side(
        lambda: prepare("rents", preparation.prep_rents),
        lambda: (prepare("users", preparation.prep_users), describe("users", dimfact.dim_users)),
        lambda: (prepare("books", preparation.prep_books), describe("books", dimfact.dim_books)),
    )
    dims = {name: stored(spark, f"{dimfact_db}.{name}") for name in ("dim_users", "dim_books")}
    table = f"{dimfact_db}.fact_rents"
    rents = _newer(spark, spark.table(f"{prep}.prep_rents"), table, rebuild, strict)
    delta = dimfact.fact_rents({"prep_rents": rents, **dims}, hot_keys(rents, "user_id", "book_id"))
    database = names["datamart"]
    _publish(delta, table, ["rent_id"], "created_at", rebuild, before=lambda days: note_days(spark, database, days))


def _side_by_side(*jobs: Callable[[], object]) -> None:
    """Runs independent jobs at once in one session; the first failure is raised after all
    have ended."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(job) for job in jobs]
    for job in running:
        job.result()


# --- days that marts owe ---------------------------------------------------------
class Owed(NamedTuple):
    """The days a mart owes (``None``: to be computed from the whole fact) and the notes
    that say so."""

    days: set | None
    notes: tuple[str, ...] = ()


def note_days(spark: SparkSession, database: str, days: set | None) -> None:
    """Notes for every mart stored by day that it owes these days (``None``: all)."""
    known = [None] if days is None else list(days)
    note = uuid.uuid4().hex
    rows = [(mart, day, days is None, note) for mart, (_, by) in MARTS.items() if by for day in known]
    if rows:
        put_parts(spark.createDataFrame(rows, "mart string, day date, whole boolean, note string"),
                  f"{database}.{OWED}", ["note"])


def owed(spark: SparkSession, database: str, mart: str) -> Owed:
    """What a mart owes: days of notes that it has not settled."""
    if not table_exists(spark, f"{database}.{OWED}"):
        return Owed(set() if table_exists(spark, f"{database}.{mart}") else None)
    rows = spark.table(f"{database}.{OWED}").where(F.col("mart") == mart)
    if table_exists(spark, f"{database}.{SETTLED}"):
        settled = spark.table(f"{database}.{SETTLED}").where(F.col("mart") == mart).select("note").distinct()
        rows = rows.join(settled, "note", "left_anti")
    found = rows.select("day", "whole", "note").distinct().collect()
    notes = tuple({r["note"] for r in found})
    if not table_exists(spark, f"{database}.{mart}") or any(r["whole"] for r in found):
        return Owed(None, notes)
    return Owed({r["day"] for r in found}, notes)


def owed_days(spark: SparkSession, database: str, mart: str) -> set | None:
    """The days a mart owes; ``None`` if it is to be computed from the whole fact."""
    return owed(spark, database, mart).days


def _settle(spark: SparkSession, database: str, mart: str, notes: tuple[str, ...]) -> None:
    """Crosses out the notes that were read before the mart was computed, and no later one."""
    if notes:
        rows = spark.createDataFrame([(True, note, mart) for note in notes], "done boolean, note string, mart string")
        put_parts(rows, f"{database}.{SETTLED}", ["note", "mart"])


def _forget(spark: SparkSession, database: str) -> None:
    """Clears away notes that every mart has settled."""
    if not table_exists(spark, f"{database}.{SETTLED}"):
        return
    marts = sum(1 for _, by in MARTS.values() if by)
    done = spark.table(f"{database}.{SETTLED}").groupBy("note").agg(F.count_distinct("mart").alias("n"))
    notes = {r["note"] for r in done.where(F.col("n") == marts).collect()}
    for name in (OWED, SETTLED) if notes else ():  # in this order: a note is never owed again
        drop_parts(spark, f"{database}.{name}", lambda part: part["note"] in notes)


def run_marts(spark: SparkSession, layers: dict = LAYERS, rebuild: bool = False,
              recent: bool = True) -> None:
    """The second part of ``run_layers``: the marts, from the stored fact and dimensions."""
    source, database = layer_name("dimfact", layers), layer_name("datamart", layers)
    fact = spark.table(f"{source}.fact_rents")
    dims = {name: stored(spark, f"{source}.{name}") for name in ("dim_users", "dim_books")}

    def publish(name: str, content: DataFrame) -> None:
        keys, by = MARTS[name]
        _publish(content, f"{database}.{name}", keys, by, rebuild, null_safe=True)

    def by_day(name: str, make: Callable[..., DataFrame], spread_by: str) -> None:
        due = owed(spark, database, name) if recent and not rebuild else Owed(None)
        table, by = f"{database}.{name}", MARTS[name][1]
        if due.days is None or due.days:
            part = fact if due.days is None else fact.where(on_days("created_date", due.days))
            content = make({"fact_rents": part, **dims}, hot=hot_keys(part, spread_by)[spread_by])
            if due.days is None:
                write_partitioned(content, table, by, day=by)
            else:  # whole days, so what a day holds no more goes as well
                replace_days(content, table, due.days, by, by)
        _settle(spark, database, name, due.notes)

    _side_by_side(
        lambda: by_day("dmart_user_book", datamart.dmart_user_book, "book_id"),
        lambda: by_day("dmart_gender_book", datamart.dmart_gender_book, "user_id"),
    )
    _forget(spark, database)
    if recent:
        counts = spark.table(f"{database}.dmart_gender_book")
        shares = datamart.book_gender_from_days(counts)
        stock = datamart.booktype_stock_from_days(counts, dims["dim_books"])
    else:
        inputs = {"fact_rents": fact, **dims}
        shares = datamart.dmart_book_gender(inputs, hot_keys(fact, "user_id")["user_id"])
        stock = datamart.dmart_booktype_stock(inputs)
    _side_by_side(
        lambda: publish("dmart_book_gender", shares), lambda: publish("dmart_booktype_stock", stock),
    )


def backfill_fact(spark: SparkSession, layers: dict = LAYERS) -> set:
    """Fills in users and books that reached the dimensions after their rentals.

    The regular run never looks at a rental again, so this is a job of its own.
    Only rentals with a gap are joined anew, and only their days are read from
    the preparation layer; they are stored with what the fact knows of them, so that later
    steps need no join by rental. Returns the days that changed; the marts owe them until
    the next run.
    """
    prep, database = layer_name("preparation", layers), layer_name("dimfact", layers)
    table = f"{database}.fact_rents"
    gap = F.col("user_id").isNull() | F.col("book_id").isNull()
    gaps = spark.table(table).where(gap).select("rent_id", "user_id", "book_id", "created_date")
    days = {row[0] for row in gaps.select("created_date").distinct().collect()}
    rents = spark.table(f"{prep}.prep_rents").where(on_days("created_date", days))
    known = gaps.select("rent_id", F.col("user_id").alias("_known_user"), F.col("book_id").alias("_known_book"))
    aside = beside(table, "gaps")
    write_partitioned(rents.join(known, "rent_id").drop("created_date"), aside, None)
    rents = spark.table(aside)
    dims = {name: stored(spark, f"{database}.{name}") for name in ("dim_users", "dim_books")}
    again = dimfact.fact_rents(
        {"prep_rents": rents, **dims}, hot_keys(rents, "user_id", "book_id"), ("_known_user", "_known_book"))
    filled = again.where(
        ~F.col("user_id").eqNullSafe(F.col("_known_user")) | ~F.col("book_id").eqNullSafe(F.col("_known_book"))
    )
    marts = ensure_layer(spark, layer_name("datamart", layers))
    changed = _publish(filled.select(*dimfact.FACT_COLUMNS), table, ["rent_id"], "created_at", False,
                       before=lambda days: note_days(spark, marts, days))
    drop_table(spark, aside)
    return changed


def _newer(spark: SparkSession, source: DataFrame, table: str, rebuild: bool,
           strict: bool) -> DataFrame:
    if rebuild or not table_exists(spark, table):
        return source
    mark = stored_watermark(spark, table)
    if mark is None:
        return source.limit(0) if strict else source
    return rows_after(source, mark, partition="created_date")


def _publish(delta: DataFrame, table: str, keys: list[str], ts: str | None, rebuild: bool,
             null_safe: bool = False, before: Callable[[set | None], None] | None = None) -> set:
    """Upserts a model's result and tells the days it reached.

    A delta for a table that holds rows is stored first, so it is computed once.
    ``before`` is told the days ahead of the write (``None``: the whole table).
    """
    spark = delta.sparkSession
    day = ts if ts == "created_at_date" else "created_date"
    if rebuild or not table_exists(spark, table):
        if before:
            before(None)
        write_partitioned(delta, table, ts, day=day)
        return stored_days(spark, table) if ts else set()
    aside = beside(table, "delta")
    write_partitioned(delta, aside, None)
    batch = spark.table(aside)
    days = set()
    if not batch.isEmpty():
        days = upsert_table(batch, table, keys, ts, null_safe, day, before=before)
    spark.sql(f"DROP TABLE {aside}")
    return days


def metric_feed(pages: DataFrame, table: str) -> bool:
    """Stored pages (html, created_at) to appended snapshots; incomplete pages are left out."""
    spark = pages.sparkSession
    complete = metric_snapshot(with_cards(pages), keep=())
    aside = beside(table, "delta")
    write_partitioned(complete, aside, None)
    done = append_metrics(spark.table(aside).select(*METRIC_LABELS, "created_at"), table)
    spark.sql(f"DROP TABLE {aside}")
    return done
