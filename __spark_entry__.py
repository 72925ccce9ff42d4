"""

``queries()`` builds on the library tables that ``rental_views`` derives from
the driver's tables; ``oracle_sql()`` states the same tables and results in SQL,
written on its own. Every query reads its tables whole.
"""

from __future__ import annotations

import os
import sys
import uuid
import warnings
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T  # noqa: E402

from lendmart.functions.scalars import metric_value  # noqa: E402
from lendmart.operators import merge, metrics, quality  # noqa: E402
from lendmart.plans import datamart, dimfact, layers, preparation, repair  # noqa: E402
from lendmart.schemas import GENRES, LAYERS, METRIC_LABELS, RENTS, TABLES  # noqa: E402
from lendmart.session import temporary_folder  # noqa: E402
from lendmart.sources import landing, readers, rental_views  # noqa: E402
from lendmart.streaming import jobs, late_counts  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

# Two versions of one table for the merge queries: an older target and a newer
# batch that overlap by a year.
TARGET_END = "1998-01-01"
BATCH_START = "1997-01-01"
SLICE = "2024-01-15"
EVENT_DELAY_DAYS = 1


# --- inputs ---------------------------------------------------------------------
_VIEWS = {"users": rental_views.users, "books": rental_views.books, "rents": rental_views.rents}


def _sources(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: _VIEWS[name](spark, sf_dir) for name in names or _VIEWS}


def _dim_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    prep = preparation.prep_users(_sources(spark, sf_dir, "users"))
    return dimfact.dim_users({"prep_users": prep})


def _dim_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    prep = preparation.prep_books(_sources(spark, sf_dir, "books"))
    return dimfact.dim_books({"prep_books": prep})


def _fact(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict]:
    """Dimensions and fact, with the frequent users and books found beforehand."""
    tables = {
        "prep_rents": preparation.prep_rents(_sources(spark, sf_dir, "rents")),
        "dim_users": _dim_users(spark, sf_dir),
        "dim_books": _dim_books(spark, sf_dir),
    }
    hot = rental_views.hot_references(spark, sf_dir)
    tables["fact_rents"] = dimfact.fact_rents(tables, hot)
    return tables, hot


def _before(df: DataFrame, end: str = TARGET_END) -> DataFrame:
    return df.where(F.col("created_at") < F.to_timestamp_ntz(F.lit(f"{end} 00:00:00")))


def _from(df: DataFrame, start: str = BATCH_START) -> DataFrame:
    return df.where(F.col("created_at") >= F.to_timestamp_ntz(F.lit(f"{start} 00:00:00")))


def _changed(rents: DataFrame) -> DataFrame:
    """A later version of rentals, all returned one day after their record."""
    return rents.withColumn("return_date", F.col("created_at") + F.expr("INTERVAL '1' DAY"))


def _scratch_database(spark: SparkSession, purpose: str) -> str:
    """A new database in the shared folder."""
    return landing.ensure_layer(spark, "lendmart_" + uuid.uuid4().hex, temporary_folder(spark, purpose))


# --- queries ------------------------------------------------------------------------
def q_fact_rents(spark, sf_dir):
    return _fact(spark, sf_dir)[0]["fact_rents"]


def q_user_book(spark, sf_dir):
    tables, hot = _fact(spark, sf_dir)
    return datamart.dmart_user_book(tables, hot=hot["book_id"])


def q_gender_book(spark, sf_dir):
    tables, hot = _fact(spark, sf_dir)
    return datamart.dmart_gender_book(tables, hot["user_id"])


def q_book_gender(spark, sf_dir):
    tables, hot = _fact(spark, sf_dir)
    return datamart.dmart_book_gender(tables, hot["user_id"])


def q_booktype_stock(spark, sf_dir):
    return datamart.dmart_booktype_stock(_fact(spark, sf_dir)[0])


def q_user_book_calendar(spark, sf_dir):
    tables, hot = _fact(spark, sf_dir)
    return datamart.dmart_user_book(tables, calendar=True, hot=hot["book_id"])


def q_daily_slice(spark, sf_dir):
    events = rental_views.table(spark, sf_dir, "events")
    return readers.daily_slice(events, SLICE, ts="ts").select(
        "event_id", "ts", "user_id", "event_type", "value"
    )


def q_normalize_ts_numeric(spark, sf_dir):
    """Epoch milliseconds that arrive as double and as decimal, as nullable columns do."""
    batch = _epoch_batch(spark, sf_dir)
    return readers.normalize_ts(batch.withColumns({
        "rent_date": F.col("rent_date").cast("double"), "return_date": F.col("return_date").cast("decimal(18,2)"),
    }))


def q_normalize_ts(spark, sf_dir):
    return readers.normalize_ts(_epoch_batch(spark, sf_dir))


def _epoch_batch(spark, sf_dir):
    rents = rental_views.rents(spark, sf_dir)
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))

    def millis(name):
        passed = F.col(name) - epoch
        return (
            F.extract(F.lit("DAY"), passed).cast("long") * 86_400_000
            + F.extract(F.lit("HOUR"), passed).cast("long") * 3_600_000
            + 789
        )

    return rents.select(
        "rent_id", millis("rent_date").alias("rent_date"),
        millis("return_date").alias("return_date"), "created_at",
    )


def q_staging_load(spark, sf_dir):
    """Rentals through CSV: normalised, written, parsed, checked and staged."""
    database, folder = _scratch_database(spark, "staging"), temporary_folder(spark, "landing")
    rents = rental_views.rents(spark, sf_dir)
    landing.write_csv(readers.normalize_ts(rents), folder)
    return landing.load_staging(spark, folder, RENTS, f"{database}.rents_staging", ts=None)


def _stored_rents(spark, sf_dir):
    """Rentals as a written table, which a merge may read several times over."""
    path = temporary_folder(spark, "rents")
    rental_views.rents(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def q_insert_only_merge(spark, sf_dir):
    rents = _stored_rents(spark, sf_dir)
    batch = _changed(_from(rents))
    staging = batch.unionByName(_from(batch, "2000-01-01"))  # part of it arrives twice
    return merge.insert_only_merge(_before(rents), staging, "rent_id")


def q_watermark_delta(spark, sf_dir):
    rents = rental_views.rents(spark, sf_dir)
    return merge.watermark_delta(rents, _before(rents))


def q_upsert_single_key(spark, sf_dir):
    rents = _stored_rents(spark, sf_dir)
    delta = merge.assert_unique(_changed(_from(rents)), "rent_id")
    return merge.upsert(_before(rents), delta, "rent_id")


def _upsert_composite(spark, sf_dir, null_safe):
    tables, hot = _fact(spark, sf_dir)
    keys = ["gender", "book_type", "genre", "created_at_date"]

    def mart(fact):
        return datamart.dmart_gender_book({**tables, "fact_rents": fact}, hot["user_id"])

    fact = tables["fact_rents"]
    return merge.upsert(mart(_before(fact)), mart(_from(fact, "1997-07-01")), keys, null_safe)


def q_upsert_composite_key(spark, sf_dir):
    return _upsert_composite(spark, sf_dir, null_safe=False)


def q_upsert_null_safe(spark, sf_dir):
    return _upsert_composite(spark, sf_dir, null_safe=True)


def q_insert_ignore(spark, sf_dir):
    users = rental_views.users(spark, sf_dir, shared_email=True)
    return merge.insert_ignore(
        _before(users, "1995-03-01"), _from(users, "1995-03-01"), "email", "user_id"
    )


def q_stock_decrement(spark, sf_dir):
    tables = _sources(spark, sf_dir, "books", "rents")
    return merge.apply_stock_decrement(tables["books"], tables["rents"])


def q_available_books(spark, sf_dir):
    tables = _sources(spark, sf_dir, "books", "rents")
    out = tables["rents"].where(F.col("return_date").isNull())
    return merge.available_books(merge.apply_stock_decrement(tables["books"], out))


def q_page_titles(spark, sf_dir):
    pages = readers.read_pages(spark, f"{sf_dir}/pages.parquet")
    return metrics.extract_labeled(pages, "html", None, "title", "h1")


def q_metric_values(spark, sf_dir):
    pages = rental_views.card_pages(spark, sf_dir)
    return metrics.extract_labeled(pages).select(
        "page_id", "ordinal", "label", metric_value("value").alias("value")
    )


def q_metric_snapshot(spark, sf_dir):
    pages = rental_views.card_pages(spark, sf_dir)
    return metrics.metric_snapshot(metrics.with_cards(pages))


def q_metric_feed(spark, sf_dir):
    """Complete snapshots of all pages, appended to the metrics table."""
    database = _scratch_database(spark, "metrics")
    layers.metric_feed(rental_views.card_pages(spark, sf_dir), f"{database}.metrics")
    return spark.table(f"{database}.metrics")



def q_table_profile(spark, sf_dir):
    tables = _sources(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        [quality.table_profile(df, name) for name, df in tables.items()],
    )


def _loose_tables(spark, sf_dir):
    """Library tables before any check: repeated rent numbers, shared emails."""
    books = rental_views.books(spark, sf_dir)
    lines = rental_views.rent_lines(spark, sf_dir).select(
        "rent_id", F.when(F.col("l_partkey") % 5 > 0, F.col("l_orderkey")).alias("user_id"),
        F.when(F.col("l_quantity") < 48, F.col("l_partkey")).alias("book_id"),
    )
    users = rental_views.users(spark, sf_dir, shared_email=True)
    return {"users": users, "books": books, "rents": lines}


def q_constraint_report(spark, sf_dir):
    return quality.constraint_report(_loose_tables(spark, sf_dir))


def q_fk_orphans(spark, sf_dir):
    tables = _sources(spark, sf_dir)
    rents = tables["rents"]
    return quality.fk_orphans(rents, tables["users"], "user_id").unionByName(
        quality.fk_orphans(rents, tables["books"], "book_id")
    )


def _event_stream(spark, sf_dir):
    schema = rental_views.table(spark, sf_dir, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )


def q_stream_insert_only(spark, sf_dir):
    """Events into an insert-only table, delivered twice in full."""
    database, folder = _scratch_database(spark, "events"), temporary_folder(spark, "checkpoints")
    for delivery in ("first", "again"):
        jobs.stream_insert_only(
            _event_stream(spark, sf_dir), f"{database}.events", "event_id",
            f"{folder}/{delivery}", ts="ts",
        ).awaitTermination()
    return landing.stored(spark, f"{database}.events")


def q_stream_daily_counts(spark, sf_dir):
    folder = temporary_folder(spark, "daily-counts")
    counts = jobs.stream_daily_counts(
        _event_stream(spark, sf_dir), "ts", ["event_type"], f"{EVENT_DELAY_DAYS} day", "events"
    )
    jobs.write_days(counts, f"{folder}/days", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/days")


def _text_queries() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the llm subpackage; none if the subpackage is not there."""
    try:
        import corpus_pipeline
        from lendmart.llm import registry
    except ImportError as missing:
        warnings.warn(f"no text queries: {missing}", stacklevel=2)
        return {}, {}
    sql = dict(registry.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return registry.QUERIES | {"pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Query]:
    """One entry per query: ``(spark, sf_dir) -> DataFrame``."""
    return _rental_queries() | _text_queries()[0]


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each query that SQL can express, over the driver's tables."""
    return _rental_sql() | _text_queries()[1]


def _rental_queries() -> dict[str, Query]:
    return {
        "prep_users": lambda s, d: preparation.prep_users(_sources(s, d, "users")),
        "prep_books": lambda s, d: preparation.prep_books(_sources(s, d, "books")),
        "prep_rents": lambda s, d: preparation.prep_rents(_sources(s, d, "rents")),
        "dim_users": _dim_users,
        "dim_books": _dim_books,
        "fact_rents": q_fact_rents,
        "dmart_user_book": q_user_book,
        "dmart_user_book_calendar": q_user_book_calendar,
        "dmart_gender_book": q_gender_book,
        "dmart_book_gender": q_book_gender,
        "dmart_booktype_stock": q_booktype_stock,
        "stock_per_type": lambda s, d: datamart.stock_per_type({"dim_books": _dim_books(s, d)}),
        "daily_slice": q_daily_slice,
        "normalize_ts": q_normalize_ts,
        "normalize_ts_numeric": q_normalize_ts_numeric,
        "layered_run": q_layered_run,
        "layered_run_after_failure": q_layered_run_after_failure,
        "upsert_stored": q_upsert_stored,
        "staging_rejects": q_staging_rejects,
        "staging_load": q_staging_load,
        "insert_only_merge": q_insert_only_merge,
        "watermark_delta": q_watermark_delta,
        "upsert_single_key": q_upsert_single_key,
        "upsert_composite_key": q_upsert_composite_key,
        "upsert_null_safe": q_upsert_null_safe,
        "insert_ignore": q_insert_ignore,
        "stock_decrement": q_stock_decrement,
        "available_books": q_available_books,
        "page_titles": q_page_titles,
        "metric_values": q_metric_values,
        "metric_snapshot": q_metric_snapshot,
        "metric_feed": q_metric_feed,
        "table_profile": q_table_profile,
        "constraint_report": q_constraint_report,
        "fk_orphans": q_fk_orphans,
        "stream_insert_only": q_stream_insert_only,
        "stream_daily_counts": q_stream_daily_counts,
        "append_new_rows": q_append_new_rows,
        "late_day_repair": q_late_day_repair,
        "backfill_fact": q_backfill_fact,
        "daily_load": q_daily_load,
        "mart_shown": q_mart_shown,
        "split_read": q_split_read,
        "stream_redelivered": q_stream_redelivered,
        "stream_counts_with_late": q_stream_counts_with_late,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: books and mean rental days per user and day."""
    return q_user_book(spark, "/root/testdata/sf0.001")


# --- stored runs ------------------------------------------------------------------
def _layer_names() -> dict[str, str]:
    tag = uuid.uuid4().hex[:8]
    return {layer: f"lendmart_{layer}_{tag}" for layer in LAYERS}


def _marts(spark, names) -> DataFrame:
    """The four stored marts as one table of common columns."""
    database = names["datamart"]
    mart = lambda name: spark.table(f"{database}.{name}")
    return reduce(DataFrame.unionAll, [
        mart("dmart_user_book").selectExpr(
            "'user_book' AS mart", "CAST(user_id AS STRING) AS a", "gender AS b", "email AS c",
            "created_at_date AS day", "sum_of_book AS n", "avg_rent_duration AS x"),
        mart("dmart_gender_book").selectExpr(
            "'gender_book' AS mart", "gender AS a", "book_type AS b", "genre AS c",
            "created_at_date AS day", "total_rentals AS n", "CAST(NULL AS DOUBLE) AS x"),
        mart("dmart_book_gender").selectExpr(
            "'book_gender' AS mart", "gender AS a", "book_type AS b", "genre AS c",
            "CAST(NULL AS DATE) AS day", "total_rentals_gender AS n", "percentage_per_gender AS x"),
        mart("dmart_booktype_stock").selectExpr(
            "'booktype_stock' AS mart", "book_type AS a", "CAST(NULL AS STRING) AS b", "CAST(NULL AS STRING) AS c",
            "CAST(NULL AS DATE) AS day", "total_rent_per_type AS n", "CAST(sisa_stock AS DOUBLE) AS x"),
    ])


def _layered(spark, sf_dir, broken: bool) -> DataFrame:
    sources, names = _sources(spark, sf_dir), _layer_names()
    for database in names.values():
        landing.ensure_layer(spark, database, temporary_folder(spark, database))
    layers.run_layers(spark, sources | {"rents": _before(sources["rents"])}, names)
    if broken:  # ends after the fact is published
        layers.run_models(spark, sources, names)
    layers.run_layers(spark, sources, names)
    return _marts(spark, names)


def q_layered_run(spark, sf_dir):
    """Two batches of rentals through all layers."""
    return _layered(spark, sf_dir, False)


def q_layered_run_after_failure(spark, sf_dir):
    """The same, with a second run that ended before the marts and was repeated."""
    return _layered(spark, sf_dir, True)


def q_upsert_stored(spark, sf_dir):
    """A stored upsert whose rows move to the next day."""
    rents = _sources(spark, sf_dir, "rents")["rents"]
    table = _scratch_database(spark, "upsert") + ".rents"
    landing.write_partitioned(_before(rents), table)
    moved = _from(rents).withColumn("created_at", F.col("created_at") + F.expr("INTERVAL '1' DAY"))
    aside = f"{table}_delta"
    landing.write_partitioned(moved, aside, None)
    landing.upsert_table(spark.table(aside), table, ["rent_id"])
    return landing.stored(spark, table)


def q_append_new_rows(spark, sf_dir):
    """A stored insert-only merge over an older target; part of the batch comes twice."""
    rents = _sources(spark, sf_dir, "rents")["rents"]
    database = _scratch_database(spark, "append")
    landing.write_partitioned(_before(rents), f"{database}.rents")
    batch = _changed(_from(rents))
    landing.write_partitioned(batch.unionAll(_from(batch, "2000-01-01")), f"{database}.batch", None)
    landing.append_new_rows(spark.table(f"{database}.batch"), f"{database}.rents", "rent_id")
    return landing.stored(spark, f"{database}.rents")


# Rentals that reach the source after later ones have been taken: some of the first batch,
# some of those with its newest time, and some that have no time.
_LATE = "(rent_id % 500 = 3 OR created_at = (SELECT max(created_at) FROM earlier) AND rent_id % 2 = 1)"


def q_late_day_repair(spark, sf_dir):
    """Two incremental loads that skip late rows, then a repair; which days it reloaded."""
    rents = _stored_rents(spark, sf_dir).withColumn(
        "created_at", F.when(F.col("rent_id") % 1009 != 0, F.col("created_at")))
    newest = _before(rents).agg(F.max("created_at")).first()[0]
    tied = (F.col("created_at") == F.to_timestamp_ntz(F.lit(str(newest)))) & (F.col("rent_id") % 2 == 1)
    held = (F.col("rent_id") % 500 == 3) | tied
    table, identity = _scratch_database(spark, "repair") + ".rents", ["rent_id", "created_at"]
    landing.write_partitioned(_before(rents).where(~held), table)
    repair.note_digests(spark, table, identity)
    delta = merge.rows_after(rents, landing.stored_watermark(spark, table))
    landing.write_partitioned(delta, table, mode="append")
    repair.absorb_digests(spark, table, delta, identity)
    days = repair.repair_table(spark, rents, table, "rent_id")
    return spark.table(table).withColumn("reloaded", landing.on_days(landing.DAY, days)).drop(landing.DAY)


def q_backfill_fact(spark, sf_dir):
    """Rentals of users that reach the dimensions later, filled in afterwards."""
    sources, names = _sources(spark, sf_dir), _layer_names()
    for database in names.values():
        landing.ensure_layer(spark, database, temporary_folder(spark, database))
    layers.run_models(spark, sources | {"users": _before(sources["users"], "1995-07-01")}, names)
    layers.run_models(spark, sources, names)
    layers.backfill_fact(spark, names)
    return landing.stored(spark, f"{names['dimfact']}.fact_rents")


def q_daily_load(spark, sf_dir):
    """Days through CSV, staging and the warehouse; one comes twice, one has no rows."""
    folder, names = temporary_folder(spark, "operational"), _layer_names()
    for name, df in _sources(spark, sf_dir).items():
        df.write.parquet(f"{folder}/{name}.parquet")
    landing.ensure_layer(spark, names["warehouse"], temporary_folder(spark, "warehouse"))
    for name, schema in TABLES.items():
        landing.ensure_table(spark, f"{names['warehouse']}.{name}", schema)
    first = readers.slice_day(datetime(1995, 6, 10, 20, tzinfo=timezone.utc))  # already the 11th in its zone
    for day in (first, "1995-06-11", first, "1970-01-01"):
        layers.daily_load(
            spark, lambda name: readers.read_source(spark, f"{name}_data", path=folder), day,
            temporary_folder(spark, "landing"), names, on_empty="skip")
    return reduce(DataFrame.unionAll, [
        landing.stored(spark, f"{names['warehouse']}.{name}").select(
            F.lit(name).alias("name"), F.col(key).alias("id"), "created_at")
        for name, key in (("users", "user_id"), ("books", "book_id"), ("rents", "rent_id"))
    ])


def q_mart_shown(spark, sf_dir):
    """The stock report in its presentation order: one row a book type."""
    mart = datamart.shown("dmart_booktype_stock", q_booktype_stock(spark, sf_dir))
    return mart.coalesce(1).select("book_type", F.monotonically_increasing_id().alias("place"))


def q_split_read(spark, sf_dir):
    """How many ranges of a split by return date each rental falls into: always one."""
    rents = _stored_rents(spark, sf_dir)
    points = readers.split_points(rents, "return_date", 16)
    ranges = readers.split_predicates(["return_date"], points)
    met = [F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in ranges]
    return rents.select("rent_id", reduce(lambda a, b: a + b, met).alias("reads"))


def _deliveries(spark, sf_dir, *parts):
    """A folder that takes events in parts, and the stream of its files; run after each part,
    it has the part's files in a micro-batch of their own."""
    events = rental_views.table(spark, sf_dir, "events")
    folder = temporary_folder(spark, "deliveries")
    for part in parts:
        rows = part(events)
        yield rows.write.mode("append").parquet(folder), jobs.stream_files(
            spark, folder, events.schema, files=1 << 20)


def q_stream_redelivered(spark, sf_dir):
    """Events with rows repeated inside and across files, deduplicated by a bounded state
    ahead of the merge."""
    table = _scratch_database(spark, "redelivered") + ".events"
    again = lambda df, n: df.unionAll(df.where(F.col("event_id") % n == 0))
    early = F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    parts = [lambda e: again(e.where(early), 10), lambda e: e.where(early), lambda e: again(e, 7)]
    checkpoint = temporary_folder(spark, "checkpoint")
    for _, stream in _deliveries(spark, sf_dir, *parts):
        jobs.stream_insert_only(stream, table, "event_id", checkpoint, ts="ts", within="1 hour").awaitTermination()
    return landing.stored(spark, table)


# Deliveries of the late events: by thirds of the month, some one or two later.
_DELIVERY = ("CAST((CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN 0 WHEN ts < TIMESTAMP '2024-01-21 00:00:00' "
             "THEN 1 ELSE 2 END) + (CASE WHEN event_id % 29 = 0 THEN 2 WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) AS INT)")


def q_stream_counts_with_late(spark, sf_dir):
    """Counts of closed days with late rows kept aside and merged in, and how many were late."""
    table = _scratch_database(spark, "late") + ".counts"
    checkpoint, delivery = temporary_folder(spark, "checkpoint"), F.expr(_DELIVERY.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
    parts = [lambda e, k=k: e.where(delivery == k) for k in range(5)]
    for _, stream in _deliveries(spark, sf_dir, *parts):
        late_counts.stream_counts_with_late(
            stream, table, "ts", ["event_type"], checkpoint, f"{EVENT_DELAY_DAYS} day", "events").awaitTermination()
    late_counts.merge_late(spark, table, ["event_type"], "events")
    late = spark.table(late_counts.side(table, "late")).groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("late"))
    return spark.table(table).join(late, ["day", "event_type"], "left").select(
        "day", "event_type", "events", F.coalesce("late", F.lit(0).cast("long")).alias("late"))


REJECTS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("created_at", T.TimestampNTZType()),
])


def q_staging_rejects(spark, sf_dir):
    """A CSV file with too few, too many and ill-typed values: what is staged, what is not."""
    customer = rental_views.table(spark, sf_dir, "customer")
    key, kind = F.col("c_custkey").cast("string"), F.col("c_custkey") % 4
    name, time = F.concat(F.lit('"'), "c_name", F.lit(', ""x"""')), F.lit("2024-05-06 07:08:09")
    line = (
        F.when(kind == 1, F.concat_ws(",", key, name)).when(kind == 2, F.concat_ws(",", key, name, time, F.lit("more")))
        .when(kind == 3, F.concat_ws(",", F.concat(F.lit("x"), key), name, time)).otherwise(F.concat_ws(",", key, name, time))
    )
    path = temporary_folder(spark, "rejects")
    customer.select(line.alias("line")).write.option("header", "false").text(path)
    table = _scratch_database(spark, "rejects") + ".customers"
    staged = landing.load_staging(spark, path, REJECTS, table, max_bad=customer.count(), header=False)
    refused = spark.table(f"{table}__rejected")
    return staged.selectExpr("'staged' AS fate", "CAST(id AS STRING) AS what", "name", "CAST(NULL AS STRING) AS reason").unionAll(
        refused.selectExpr("'rejected' AS fate", "regexp_extract(line, '^[^,]*', 0) AS what", "CAST(NULL AS STRING) AS name", "reason")
    )


# --- SQL counterparts ------------------------------------------------------------------
_USERS = """users AS (
  SELECT c_custkey AS user_id, c_name AS name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         'Nation ' || c_nationkey AS address,
         CASE WHEN c_acctbal < 0 THEN NULL
              WHEN c_nationkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
         TIMESTAMP '1995-01-01 08:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at
  FROM customer)"""

_BOOKS = """books AS (
  SELECT p_partkey AS book_id, p_name AS title, p_brand AS author,
         CASE p_size % 5 WHEN 0 THEN 'Novel' WHEN 1 THEN 'Comic' WHEN 2 THEN 'Biography'
                         WHEN 3 THEN 'Encyclopedia' ELSE 'Magazine' END AS book_type,
         CASE p_type WHEN 'ECONOMY' THEN 'Fiction' WHEN 'SMALL' THEN 'Non-Fiction'
                     WHEN 'MEDIUM' THEN 'Mystery' WHEN 'PROMO' THEN 'Thriller'
                     WHEN 'STANDARD' THEN 'Romance' ELSE 'Technology' END AS genre,
         'Publisher of ' || p_brand AS publisher,
         CAST(2000 + p_size % 24 AS BIGINT) AS release_year,
         CAST(1 + p_size % 10 AS BIGINT) AS stock,
         TIMESTAMP '1995-01-01 09:00:00' + to_days(CAST(p_partkey % 365 AS INTEGER)) AS created_at
  FROM part)"""

_RENTS = """lines AS (
  SELECT l_orderkey, l_linenumber, min(l_partkey) AS part, min(l_quantity) AS quantity,
         max(l_returnflag) AS flag, max(l_shipdate) AS shipped
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
rents AS (
  SELECT l_orderkey * 8 + l_linenumber AS rent_id,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
              THEN -1 - o_custkey ELSE o_custkey END AS user_id,
         CASE WHEN quantity >= 49 THEN -1 - part ELSE part END AS book_id,
         o_orderdate AS rent_date,
         CASE WHEN flag = 'N' THEN NULL
              ELSE shipped + INTERVAL 17 HOUR END AS return_date,
         o_orderdate + INTERVAL 45 DAY + INTERVAL 10 HOUR AS created_at
  FROM lines JOIN orders ON l_orderkey = o_orderkey)"""

_FACT = f"""{_USERS}, {_BOOKS}, {_RENTS},
fact AS (
  SELECT r.rent_id, r.rent_date, r.return_date, u.user_id, u.name AS user_name, u.email,
         u.gender, b.book_id, b.title, b.author, b.book_type, b.genre, b.release_year,
         r.created_at
  FROM rents r LEFT JOIN users u ON r.user_id = u.user_id
               LEFT JOIN books b ON r.book_id = b.book_id)"""


def _user_book_sql(days: str) -> str:
    return f"""WITH {_FACT}
SELECT f.user_id, f.user_name, u.email, u.gender, count(f.book_id) AS sum_of_book,
       coalesce(ceil(avg(CASE WHEN f.return_date IS NOT NULL
                              THEN greatest({days}, 0) END)), 0) AS avg_rent_duration,
       CAST(f.created_at AS DATE) AS created_at_date
FROM fact f LEFT JOIN users u ON f.user_id = u.user_id
            LEFT JOIN books b ON f.book_id = b.book_id
GROUP BY f.user_id, f.user_name, u.email, u.gender, CAST(f.created_at AS DATE)"""


def _gender_book_sql(condition: str = "TRUE") -> str:
    return f"""SELECT u.gender, b.book_type, b.genre, count(f.book_id) AS total_rentals,
       CAST(f.created_at AS DATE) AS created_at_date
FROM fact f LEFT JOIN users u ON f.user_id = u.user_id
            LEFT JOIN books b ON f.book_id = b.book_id
WHERE {condition}
GROUP BY u.gender, b.book_type, b.genre, CAST(f.created_at AS DATE)"""


def _upsert_composite_sql(same: str) -> str:
    keys = ("gender", "book_type", "genre", "created_at_date")
    match = " AND ".join(f"t.{k} {same} d.{k}" for k in keys)
    return f"""WITH {_FACT},
target AS ({_gender_book_sql(f"f.created_at < TIMESTAMP '{TARGET_END}'")}),
delta AS ({_gender_book_sql("f.created_at >= TIMESTAMP '1997-07-01'")})
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE {match})
UNION ALL SELECT * FROM delta"""


_HOUSEHOLDS = f"""{_USERS}, households AS (
  SELECT u.user_id, u.name,
         lower(c_mktsegment) || '.' || c_nationkey || '.'
           || CAST(floor(c_acctbal / 1000) AS BIGINT) || '@example.com' AS email,
         u.address, u.gender, u.created_at
  FROM users u JOIN customer ON c_custkey = u.user_id)"""

# Cards of the synthetic pages: number k shows (page_id * (k + 1)) % 97 in one of
# three notations. Every page row stands for itself, also if a page is stored twice.
def _figure(k: int) -> str:
    base = f"(page_id * {k + 1}) % 97"
    return (f"{base} * 1000 + 500", f"{base} * 1000000", base)[k % 3]


def _card_sql() -> str:
    def cards(ordinal, label, value, where="TRUE"):
        return (f"SELECT page_id, CAST({ordinal} AS INTEGER) AS ordinal, '{label}' AS label, "
                f"CAST({value} AS BIGINT) AS value FROM pages WHERE {where}")

    short = "CASE WHEN page_id % 9 = 0 THEN 1 ELSE 0 END"
    again = "CASE WHEN page_id % 7 IN (3, 5) THEN 1 ELSE 0 END"
    last = len(METRIC_LABELS) - 1
    rows = [cards(k, label, _figure(k), "page_id % 9 <> 0" if k == last else "TRUE")
            for k, label in enumerate(METRIC_LABELS)]
    rows.append(cards(f"10 - {short}", METRIC_LABELS[0],
                      "CASE page_id % 7 WHEN 5 THEN 7000000 END", "page_id % 7 IN (3, 5)"))
    rows.append(cards(f"10 - {short} + {again}", "Unlisted figure", "1"))
    return "\nUNION ALL ".join(rows)


def _snapshot_sql(first: str = "") -> str:
    columns = [f'CASE page_id % 7 WHEN 5 THEN 7000000 ELSE {_figure(0)} END AS "{METRIC_LABELS[0]}"']
    columns += [f'{_figure(k)} AS "{label}"' for k, label in enumerate(METRIC_LABELS) if k]
    return f"""SELECT {first}{", ".join(columns)},
       TIMESTAMP '2025-02-08 03:00:00' + to_days(CAST(page_id AS INTEGER)) AS created_at
FROM pages WHERE page_id % 9 <> 0 AND page_id % 7 <> 3"""


def _genre_column(genre: str) -> str:
    return f"""count(f.book_id) FILTER (b.genre = '{genre}') AS "{genre}\""""


def _text_of(tag: str) -> str:
    text = f"regexp_extract(html, '<{tag}>(.*?)</{tag}>', 1, 's')"
    for entity, character in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"),
                              ("nbsp", " "), ("amp", "&")):
        # Cut-off titles may end in an entity without its semicolon.
        text = f"regexp_replace({text}, '&{entity}(;|$)', '{character}', 'g')"
    return f"trim({text})"


_PROFILE_TYPES = {
    "users": ("bigint", "string", "string", "string", "string", "timestamp_ntz"),
    "books": ("bigint", "string", "string", "string", "string", "string", "bigint", "bigint",
              "timestamp_ntz"),
    "rents": ("bigint", "bigint", "bigint", "timestamp_ntz", "timestamp_ntz", "timestamp_ntz"),
}
_PROFILE_COLUMNS = {
    "users": ("user_id", "name", "email", "address", "gender", "created_at"),
    "books": ("book_id", "title", "author", "book_type", "genre", "publisher", "release_year",
              "stock", "created_at"),
    "rents": ("rent_id", "user_id", "book_id", "rent_date", "return_date", "created_at"),
}


def _profile_sql() -> str:
    rows = [
        f"""SELECT '{table}' AS table_name, {i} AS position, '{column}' AS column_name,
       '{dtype}' AS data_type, count(*) AS row_count, count({column}) AS non_null_count
FROM {table}"""
        for table, columns in _PROFILE_COLUMNS.items()
        for i, (column, dtype) in enumerate(zip(columns, _PROFILE_TYPES[table]))
    ]
    return f"WITH {_USERS}, {_BOOKS}, {_RENTS}\n" + "\nUNION ALL ".join(rows)


def _constraint_sql() -> str:
    def rule(table, column, name, violations):
        return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{name}' AS rule, "
                f"CAST({violations} AS BIGINT) AS violations FROM {table}")

    def not_null(table, *columns):
        return [rule(table, c, "not_null", f"count(*) - count({c})") for c in columns]

    def unique(table, column, name):
        return [rule(table, column, name, f"count({column}) - count(DISTINCT {column})")]

    def length(table, limit, *columns):
        return [
            rule(table, c, f"max_length_{limit}", f"count(*) FILTER (length({c}) > {limit})")
            for c in columns
        ]

    rows = [
        *not_null("members", "user_id", "name", "email"),
        *length("members", 100, "name", "email"), *length("members", 10, "gender"),
        *unique("members", "user_id", "primary_key"), *unique("members", "email", "unique"),
        *not_null("books", "book_id", "title", "author", "stock"),
        *length("books", 255, "title"),
        *length("books", 100, "author", "book_type", "genre", "publisher"),
        *unique("books", "book_id", "primary_key"),
        *not_null("loans", "rent_id", "user_id", "book_id"),
        *unique("loans", "rent_id", "primary_key"),
    ]
    rows = [r.replace("SELECT 'members'", "SELECT 'users'").replace("SELECT 'loans'", "SELECT 'rents'")
            for r in rows]
    return f"""WITH {_HOUSEHOLDS}, {_BOOKS}, members AS (SELECT * FROM households),
loans AS (SELECT l_orderkey * 8 + l_linenumber AS rent_id,
                 CASE WHEN l_partkey % 5 > 0 THEN l_orderkey END AS user_id,
                 CASE WHEN l_quantity < 48 THEN l_partkey END AS book_id FROM lineitem)
""" + "\nUNION ALL ".join(rows)


def _rental_sql() -> dict[str, str]:
    target = f"target AS (SELECT * FROM rents WHERE created_at < TIMESTAMP '{TARGET_END}')"
    batch = f"""batch AS (
  SELECT rent_id, user_id, book_id, rent_date, created_at + INTERVAL 1 DAY AS return_date,
         created_at
  FROM rents WHERE created_at >= TIMESTAMP '{BATCH_START}')"""
    dim_users = f"WITH {_USERS} SELECT user_id, name, email, gender, created_at FROM users"
    dim_books = f"""WITH {_BOOKS}
SELECT book_id, title, author, book_type, genre, release_year, stock, created_at FROM books"""
    text = "strftime({}, '%Y-%m-%d %H:%M:%S')"
    sql = {
        "prep_users": dim_users,
        "prep_books": dim_books,
        "prep_rents": f"WITH {_RENTS} SELECT * FROM rents",
        "dim_users": dim_users,
        "dim_books": dim_books,
        "fact_rents": f"WITH {_FACT} SELECT * FROM fact",
        "dmart_user_book": _user_book_sql("date_sub('day', f.return_date, f.created_at)"),
        "dmart_user_book_calendar": _user_book_sql("date_diff('day', f.return_date, f.created_at)"),
        "dmart_gender_book": f"WITH {_FACT} {_gender_book_sql()}",
        "dmart_book_gender": f"""WITH {_FACT},
counted AS (
  SELECT b.book_type, b.genre, u.gender, count(f.book_id) AS n
  FROM fact f LEFT JOIN users u ON f.user_id = u.user_id
              JOIN books b ON f.book_id = b.book_id
  WHERE b.book_type IS NOT NULL AND b.genre IS NOT NULL
  GROUP BY b.book_type, b.genre, u.gender)
SELECT book_type, genre, gender, n AS total_rentals_gender,
       CAST(sum(n) OVER same AS BIGINT) AS total_rentals_all,
       round(100.0::DOUBLE * n / sum(n) OVER same, 2) AS percentage_per_gender
FROM counted WINDOW same AS (PARTITION BY book_type, genre)""",
        "dmart_booktype_stock": f"""WITH {_FACT}
SELECT b.book_type, {", ".join(_genre_column(g) for g in GENRES)},
       count(f.book_id) AS total_rent_per_type, s.stock AS stock_book_per_type,
       coalesce(s.stock, 0) - count(f.book_id) AS sisa_stock
FROM fact f
LEFT JOIN books b ON f.book_id = b.book_id
LEFT JOIN (SELECT book_type, CAST(sum(stock) AS BIGINT) AS stock FROM books GROUP BY book_type) s
       ON s.book_type = b.book_type
GROUP BY b.book_type, s.stock""",
        "stock_per_type": f"""WITH {_BOOKS}
SELECT book_type, CAST(sum(stock) AS BIGINT) AS stock_book_per_type FROM books GROUP BY book_type""",
        "daily_slice": f"""SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '{SLICE} 00:00:00' AND ts < TIMESTAMP '{SLICE} 23:59:59'""",
        "normalize_ts": f"""WITH {_RENTS}
SELECT rent_id, {text.format("rent_date")} AS rent_date,
       {text.format("return_date")} AS return_date, {text.format("created_at")} AS created_at
FROM rents""",
        "staging_load": f"WITH {_RENTS} SELECT * FROM rents",
        "insert_only_merge": f"""WITH {_RENTS}, {target}, {batch},
staging AS (SELECT * FROM batch
            UNION ALL SELECT * FROM batch WHERE created_at >= TIMESTAMP '2000-01-01')
SELECT * FROM target
UNION ALL
SELECT DISTINCT * FROM staging s
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.rent_id = s.rent_id)""",
        "watermark_delta": f"""WITH {_RENTS}, {target}
SELECT * FROM rents WHERE created_at > (SELECT max(created_at) FROM target)""",
        "upsert_single_key": f"""WITH {_RENTS}, {target}, {batch}
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.rent_id = t.rent_id)
UNION ALL SELECT * FROM batch""",
        "upsert_composite_key": _upsert_composite_sql("="),
        "upsert_null_safe": _upsert_composite_sql("IS NOT DISTINCT FROM"),
        "insert_ignore": f"""WITH {_HOUSEHOLDS},
target AS (SELECT * FROM households WHERE created_at < TIMESTAMP '1995-03-01')
SELECT * FROM target
UNION ALL
SELECT * FROM (
  SELECT * FROM households h
  WHERE created_at >= TIMESTAMP '1995-03-01'
    AND NOT EXISTS (SELECT 1 FROM target t WHERE t.email = h.email)
  QUALIFY row_number() OVER (PARTITION BY email ORDER BY user_id) = 1)""",
        "stock_decrement": f"""WITH {_BOOKS}, {_RENTS}
SELECT b.book_id, title, author, book_type, genre, publisher, release_year,
       stock - (SELECT count(*) FROM rents r WHERE r.book_id = b.book_id) AS stock, b.created_at
FROM books b""",
        "available_books": f"""WITH {_BOOKS}, {_RENTS}
SELECT book_id, left_over AS stock
FROM (SELECT b.book_id, b.stock - count(r.rent_id) AS left_over
      FROM books b LEFT JOIN rents r ON r.book_id = b.book_id AND r.return_date IS NULL
      GROUP BY b.book_id, b.stock)
WHERE left_over > 0""",
        "page_titles": f"""SELECT page_id, 0 AS ordinal, {_text_of("title")} AS label,
       {_text_of("h1")} AS value
FROM pages""",
        "metric_values": _card_sql(),
        "metric_snapshot": _snapshot_sql("page_id, "),
        "metric_feed": _snapshot_sql(),
        "table_profile": _profile_sql(),
        "constraint_report": _constraint_sql(),
        "fk_orphans": f"""WITH {_USERS}, {_BOOKS}, {_RENTS}
SELECT 'user_id' AS column_name, user_id AS key_value, count(*) AS orphan_rows
FROM rents WHERE user_id NOT IN (SELECT user_id FROM users) GROUP BY user_id
UNION ALL
SELECT 'book_id', book_id, count(*)
FROM rents WHERE book_id NOT IN (SELECT book_id FROM books) GROUP BY book_id""",
        "stream_insert_only": "SELECT DISTINCT * FROM events",
        "stream_daily_counts": f"""SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events
FROM events
GROUP BY CAST(ts AS DATE), event_type
HAVING CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY
       <= (SELECT max(ts) FROM events) - INTERVAL {EVENT_DELAY_DAYS} DAY""",
    }
    numeric = {"normalize_ts_numeric": sql["normalize_ts"]}
    stored = {
        "upsert_stored": f"""WITH {_RENTS}, {target},
batch AS (SELECT rent_id, user_id, book_id, rent_date, return_date, created_at + INTERVAL 1 DAY AS created_at
          FROM rents WHERE created_at >= TIMESTAMP '{BATCH_START}')
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.rent_id = t.rent_id)
UNION ALL SELECT rent_id, user_id, book_id, rent_date, return_date, created_at FROM batch""",
        "staging_rejects": """SELECT CASE WHEN c_custkey % 4 IN (1, 3) THEN 'rejected' ELSE 'staged' END AS fate,
  CASE WHEN c_custkey % 4 = 3 THEN 'x' ELSE '' END || c_custkey AS what,
  CASE WHEN c_custkey % 4 IN (0, 2) THEN c_name || ', "x"' END AS name,
  CASE c_custkey % 4 WHEN 1 THEN 'too few values' WHEN 3 THEN 'id is no bigint' END AS reason
FROM customer""",
    }
    untimed = "SELECT * REPLACE (CASE WHEN rent_id % 1009 <> 0 THEN created_at END AS created_at) FROM rents"
    stored |= {
        "append_new_rows": sql["insert_only_merge"],
        "late_day_repair": f"""WITH {_RENTS}, source AS ({untimed}),
earlier AS (SELECT * FROM source WHERE created_at < TIMESTAMP '{TARGET_END}'),
first AS (SELECT * FROM earlier WHERE NOT {_LATE}),
skipped AS (SELECT DISTINCT CAST(created_at AS DATE) AS day FROM source
            WHERE created_at IS NULL OR (created_at <= (SELECT max(created_at) FROM first)
                  AND rent_id NOT IN (SELECT rent_id FROM first)))
SELECT s.*, EXISTS (SELECT 1 FROM skipped k WHERE k.day IS NOT DISTINCT FROM CAST(s.created_at AS DATE)) AS reloaded
FROM source s""",
        "backfill_fact": sql["fact_rents"],
        "daily_load": f"""WITH {_USERS}, {_BOOKS}, {_RENTS}, loaded AS (
  SELECT 'users' AS name, user_id AS id, created_at FROM users
  UNION ALL SELECT 'books', book_id, created_at FROM books
  UNION ALL SELECT 'rents', rent_id, created_at FROM rents)
SELECT * FROM loaded WHERE (created_at >= TIMESTAMP '1995-06-10' AND created_at < TIMESTAMP '1995-06-10 23:59:59')
  OR (created_at >= TIMESTAMP '1995-06-11' AND created_at < TIMESTAMP '1995-06-11 23:59:59')""",
        "mart_shown": f"""SELECT book_type, row_number() OVER (ORDER BY book_type NULLS FIRST) - 1 AS place
FROM ({sql["dmart_booktype_stock"]}) m""",
        "split_read": f"WITH {_RENTS} SELECT rent_id, CAST(1 AS INTEGER) AS reads FROM rents",
        "stream_redelivered": "SELECT DISTINCT * FROM events",
        "stream_counts_with_late": f"""WITH e AS (SELECT *, CAST(ts AS DATE) AS day, {_DELIVERY} AS k FROM events),
marks AS (SELECT k, CAST(max(max(ts)) OVER (ORDER BY k) - INTERVAL {EVENT_DELAY_DAYS} DAY AS DATE) AS closed FROM e GROUP BY k),
seen AS (SELECT e.*, coalesce(day < (SELECT max(closed) FROM marks m WHERE m.k < e.k), FALSE) AS late FROM e)
SELECT day, event_type, count(*) AS events, count(*) FILTER (late) AS late FROM seen
WHERE day < (SELECT max(closed) FROM marks) GROUP BY day, event_type""",
    }
    marts = f"""SELECT 'user_book' AS mart, CAST(user_id AS VARCHAR) AS a, gender AS b, email AS c,
  created_at_date AS day, sum_of_book AS n, avg_rent_duration AS x FROM ({sql["dmart_user_book"]}) u
UNION ALL SELECT 'gender_book', gender, book_type, genre, created_at_date, total_rentals, NULL
FROM ({sql["dmart_gender_book"]}) g
UNION ALL SELECT 'book_gender', gender, book_type, genre, NULL, total_rentals_gender, percentage_per_gender
FROM ({sql["dmart_book_gender"]}) s
UNION ALL SELECT 'booktype_stock', book_type, NULL, NULL, NULL, total_rent_per_type, CAST(sisa_stock AS DOUBLE)
FROM ({sql["dmart_booktype_stock"]}) t"""
    return sql | numeric | stored | {"layered_run": marts, "layered_run_after_failure": marts}
