"""The scheduled jobs end to end, streams and generated data."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from lendmart.operators.generate import synth_books, synth_rents, synth_users
from lendmart.operators.merge import apply_stock_decrement, insert_ignore
from lendmart.operators.quality import constraint_report, fk_orphans
from lendmart.plans import datamart, dimfact, layers as jobs
from lendmart.schemas import BOOK_TYPES, GENDERS, GENRES, TABLES
from lendmart.session import shared_folder
from lendmart.sources import landing
from lendmart.sources.readers import EmptySlice
from lendmart.streaming.jobs import stream_daily_counts, stream_insert_only, write_days

D1, D2, D3 = "2025-01-01", "2025-01-02", "2025-01-03"


def source(spark):
    """Three days of an operational database."""
    users = [(1, "Ada", "a@x", "s", "Female", at(f"{D1} 08:00:00")),
             (2, "Budi", "b@x", "s", "Male", at(f"{D1} 09:00:00")),
             (3, "Citra", "c@x", None, None, at(f"{D2} 08:00:00"))]
    books = [(1, "T1", "A", "Novel", "Fiction", "P", 2001, 5, at(f"{D1} 08:00:00")),
             (2, "T2", "A", "Comic", "Mystery", "P", None, 3, at(f"{D2} 08:00:00"))]
    rents = [(1, 1, 1, at(f"{D1} 10:00:00"), at("2024-12-30 10:00:00"), at(f"{D1} 10:00:00")),
             (2, 3, 1, None, None, at(f"{D1} 11:00:00")),  # user 3 is not known yet
             (3, 3, 2, None, at("2024-12-31 23:00:00"), at(f"{D2} 10:00:00")),
             (4, 2, 2, None, None, at(f"{D2} 23:59:59"))]  # in the last second of its day
    data = {"users": users, "books": books, "rents": rents}
    return {name: spark.createDataFrame(data[name], schema) for name, schema in TABLES.items()}


def table(spark, layers, layer, name):
    return landing.stored(spark, f"{layers[layer]}.{name}")


def test_two_days(spark, layers, tmp_path):
    tables = source(spark)
    load = lambda day: jobs.daily_load(spark, tables.get, day, str(tmp_path), layers)
    assert load(D1) == ["users", "books", "rents"]
    jobs.run_layers(spark, layers=layers)
    fact = table(spark, layers, "dimfact", "fact_rents")
    assert rows(fact.select("rent_id", "user_id", "book_id")) == [(1, 1, 1), (2, None, 1)]

    load(D2)
    # A repeated load adds nothing, with or without the CSV step.
    jobs.daily_load(spark, tables.get, D2, str(tmp_path), layers, through_csv=False)
    assert table(spark, layers, "warehouse", "rents").count() == 3
    for recent in (False, True):  # neither does a repeated model run
        jobs.run_layers(spark, layers=layers, recent_marts=recent)
        fact = table(spark, layers, "dimfact", "fact_rents")
        # Rental 2 was joined before its user arrived and keeps its NULL.
        assert rows(fact.select("rent_id", "user_id", "book_id", "release_year")) == [
            (1, 1, 1, 2001), (2, None, 1, 2001), (3, 3, 2, None)]
        mart = table(spark, layers, "datamart", "dmart_user_book")
        assert rows(mart.select("user_id", "sum_of_book", "avg_rent_duration", "created_at_date")) == [
            (None, 1, 0.0, date(2025, 1, 1)), (1, 1, 2.0, date(2025, 1, 1)),
            (3, 1, 1.0, date(2025, 1, 2))]
        assert rows(table(spark, layers, "datamart", "dmart_book_gender")) == [
            ("Comic", "Mystery", None, 1, 1, 100.0),
            ("Novel", "Fiction", None, 1, 2, 50.0), ("Novel", "Fiction", "Female", 1, 2, 50.0)]
        stock = table(spark, layers, "datamart", "dmart_booktype_stock")
        assert rows(stock.select("book_type", "total_rent_per_type", "sisa_stock")) == [
            ("Comic", 1, 2), ("Novel", 2, 3)]
        assert table(spark, layers, "datamart", "dmart_gender_book").count() == 3

    assert jobs.backfill_fact(spark, layers) == {date(2025, 1, 1)}
    fact = table(spark, layers, "dimfact", "fact_rents")
    assert rows(fact.select("rent_id", "user_id")) == [(1, 1), (2, 3), (3, 3)]
    assert jobs.backfill_fact(spark, layers) == set()

    jobs.run_layers(spark, layers=layers, rebuild=True)
    assert rows(table(spark, layers, "dimfact", "fact_rents")) == rows(fact)
    assert rows(table(spark, layers, "datamart", "dmart_user_book").select("user_id")) == [(1,), (3,), (3,)]


@pytest.mark.parametrize("recent", [False, True])
def test_incremental_equals_full(spark, layers, recent):
    """In-order days, one run each, against one run over everything."""
    now = at("2025-01-10 00:00:00")
    users, books = synth_users(spark, 40, 1, now), synth_books(spark, 30, 1, now)
    rents = synth_rents(users, books, 200, 1, now).withColumn(
        "created_at", F.lit(now).cast("timestamp_ntz")
        + F.make_dt_interval((F.col("rent_id") / 70).cast("int")))
    for last in (10, 11, 12) if recent else (10, 12):
        upto = rents.where(F.to_date("created_at") <= F.lit(date(2025, 1, last)))
        jobs.run_layers(spark, {"users": users, "books": books, "rents": upto}, layers,
                        recent_marts=recent)
    inputs = {"prep_rents": rents, "dim_users": users, "dim_books": books}
    full = dimfact.fact_rents(inputs)
    assert rows(table(spark, layers, "dimfact", "fact_rents")) == rows(full)
    inputs["fact_rents"] = full
    for name in jobs.MARTS:
        expected = getattr(datamart, name)(inputs)
        assert rows(table(spark, layers, "datamart", name)) == rows(expected), name


def test_empty_target_and_empty_day(spark, layers, tmp_path):
    tables = source(spark)
    with pytest.raises(EmptySlice):
        jobs.daily_load(spark, tables.get, "2024-06-01", str(tmp_path), layers)
    assert jobs.daily_load(spark, tables.get, "2024-06-01", str(tmp_path), layers, "skip") == []
    nothing = {name: df.limit(0) for name, df in tables.items()}
    jobs.run_layers(spark, nothing, layers, recent_marts=True)
    jobs.run_layers(spark, tables, layers, strict=True)
    assert table(spark, layers, "dimfact", "fact_rents").isEmpty()
    jobs.run_layers(spark, tables, layers)
    assert table(spark, layers, "dimfact", "fact_rents").count() == 4


def expected_marts(spark, layers):
    inputs = {"fact_rents": table(spark, layers, "dimfact", "fact_rents").drop("created_date"),
              "dim_users": table(spark, layers, "dimfact", "dim_users").drop("created_date"),
              "dim_books": table(spark, layers, "dimfact", "dim_books").drop("created_date")}
    return {name: rows(getattr(datamart, name)(inputs)) for name in jobs.MARTS}


def stored_marts(spark, layers):
    return {name: rows(table(spark, layers, "datamart", name)) for name in jobs.MARTS}


@pytest.mark.parametrize("first", [True, False])
def test_run_that_ended_before_the_marts_is_caught_up(spark, layers, first):
    tables = source(spark)
    if not first:
        early = tables["rents"].where(F.to_date("created_at") <= F.lit(date(2025, 1, 1)))
        jobs.run_layers(spark, tables | {"rents": early}, layers)
    jobs.run_models(spark, tables, layers)
    jobs.run_layers(spark, tables, layers)
    assert stored_marts(spark, layers) == expected_marts(spark, layers)
    assert not any(jobs.owed_days(spark, layers["datamart"], name) for name in jobs.MARTS)


def test_marts_follow_a_backfill(spark, layers):
    tables = source(spark)
    # user 3 reaches the dimensions after the rentals
    jobs.run_layers(spark, tables | {"users": tables["users"].where("user_id < 3")}, layers)
    jobs.run_layers(spark, tables, layers)
    days = jobs.backfill_fact(spark, layers)
    assert days and jobs.owed_days(spark, layers["datamart"], "dmart_user_book") == days
    jobs.run_layers(spark, tables, layers)
    found = table(spark, layers, "datamart", "dmart_user_book").where("user_id = 3")
    want = [r for r in expected_marts(spark, layers)["dmart_user_book"] if r[0] == 3]
    assert want and rows(found) == want


def test_empty_table_stops_no_other(spark, layers, tmp_path):
    tables = source(spark)
    late = tables | {"users": tables["users"].limit(0)}
    with pytest.raises(EmptySlice, match="users"):
        jobs.daily_load(spark, late.get, D1, str(tmp_path), layers)
    assert not table(spark, layers, "warehouse", "books").isEmpty()


def test_watermark_prunes_days(spark, layers):
    tables = source(spark)
    jobs.run_layers(spark, tables, layers)
    later = jobs._newer(spark, spark.table(f"{layers['preparation']}.prep_rents"),
                        f"{layers['dimfact']}.fact_rents", False, False)
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan
    assert "GreaterThan(created_at" in plan


# --- streams ------------------------------------------------------------------------------
EVENT = "id long, kind string, created_at timestamp_ntz"


def events(spark, folder, *data):
    spark.createDataFrame(data, EVENT).coalesce(1).write.mode("append").parquet(folder)


def test_stream_merges_by_key(spark, database, tmp_path):
    folder, target = str(tmp_path / "in"), f"{database}.events"

    def run(checkpoint):
        src = spark.readStream.schema(EVENT).parquet(folder)
        stream_insert_only(src, target, "id", str(tmp_path / checkpoint)).awaitTermination()
        return sorted(r.id for r in spark.table(target).collect())

    events(spark, folder, (1, "a", at(D1)), (1, "a", at(D1)), (2, "b", at(D1)), (7, "x", None))
    assert run("c1") == [1, 2]
    events(spark, folder, (2, "z", at(D2)), (3, "c", at(D2)))
    assert run("c1") == [1, 2, 3]
    assert run("c2") == [1, 2, 3]  # all files once more, as after a lost checkpoint


def test_stream_counts_closed_days(spark, tmp_path):
    folder = str(tmp_path / "in")

    def run():
        src = spark.readStream.schema(EVENT).parquet(folder)
        counts = stream_daily_counts(src, "created_at", ["kind"], "1 day", "n")
        write_days(counts, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")))

    events(spark, folder, (1, "a", at(f"{D1} 01:00:00")), (2, "a", at(f"{D1} 23:59:59")),
           (3, "b", at(f"{D2} 00:00:00")))
    assert run() == []
    events(spark, folder, (4, "b", at(f"{D3} 12:00:00")))
    first = run()
    assert first == [(date(2025, 1, 1), "a", 2)]
    # Too late for its closed day, and a row that moves the watermark on.
    events(spark, folder, (5, "a", at(f"{D1} 02:00:00")), (6, "c", at("2025-01-09 00:00:00")))
    assert run() == [*first, (date(2025, 1, 2), "b", 1), (date(2025, 1, 3), "b", 1)]


# --- generated data ---------------------------------------------------------------------------
def test_generated_tables(spark):
    now = "2025-01-10 12:00:00"
    users, books = synth_users(spark, 500, 7, now), synth_books(spark, 300, 7, now)
    assert rows(users) == rows(synth_users(spark, 500, 7, now).repartition(7))
    assert rows(users) != rows(synth_users(spark, 500, 8, now))
    assert users.schema.simpleString() == TABLES["users"].simpleString()
    assert books.schema.simpleString() == TABLES["books"].simpleString()
    assert {r[0] for r in users.select("gender").distinct().collect()} == set(GENDERS)
    assert {r[0] for r in books.select("book_type").distinct().collect()} == set(BOOK_TYPES)
    assert {r[0] for r in books.select("genre").distinct().collect()} == set(GENRES)
    low, high, few, many = books.agg(
        F.min("release_year"), F.max("release_year"), F.min("stock"), F.max("stock")).first()
    assert (low, high, few, many) == (2000, 2023, 1, 10)
    assert users.where("email = concat(lower(replace(name, ' ', '.')), '@example.com')").count() == 500
    kept = insert_ignore(users.limit(0), users, "email", "user_id")
    report = {(r.column_name, r.rule): r.violations
              for r in constraint_report({"users": kept, "books": books}).collect()}
    assert not any(report.values())


def test_generated_rents(spark):
    now = "2025-01-10 12:00:00"
    users = synth_users(spark, 700, 7, now)
    books = synth_books(spark, 300, 7, now).withColumn(
        "stock", F.when(F.col("book_id") % 2 == 0, 0).otherwise(F.col("stock")))
    rents = synth_rents(users, books, 5000, 3, now)
    assert rents.schema.simpleString() == TABLES["rents"].simpleString()
    assert rents.select("rent_id").distinct().count() == rents.count() == 5000
    assert fk_orphans(rents, users, "user_id").isEmpty()
    assert fk_orphans(rents, books.where("stock > 0"), "book_id").isEmpty()
    assert rents.select("user_id").distinct().count() > 650
    assert rents.groupBy("book_id").count().agg(F.max("count")).first()[0] < 200
    span = rents.select(
        F.extract(F.lit("DAY"), F.col("created_at") - F.col("rent_date")).alias("ago"),
        F.extract(F.lit("DAY"), F.col("return_date") - F.col("rent_date")).alias("kept"),
    ).agg(F.min("ago"), F.max("ago"), F.min("kept"), F.max("kept")).first()
    assert tuple(span) == (3, 7, 1, 3)
    held = books.agg(F.sum("stock")).first()[0]
    left = apply_stock_decrement(books, rents).agg(F.sum("stock")).first()[0]
    assert held - left == 5000
    assert synth_rents(users, books.where("stock < 0"), 10, 3, now).isEmpty()
    assert synth_rents(users.limit(0), books, 10, 3, now).isEmpty()


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second


def test_day_noted_while_a_mart_is_computed_stays_owed(spark, layers, monkeypatch):
    tables = source(spark)
    jobs.run_layers(spark, tables | {"rents": tables["rents"].where("rent_id < 3")}, layers)
    jobs.run_models(spark, tables, layers)
    later = {date(2024, 12, 31)}
    make = datamart.dmart_user_book
    monkeypatch.setattr(jobs.datamart, "dmart_user_book", lambda *a, **k: (
        jobs.note_days(spark, layers["datamart"], later), make(*a, **k))[1])
    jobs.run_marts(spark, layers)
    assert jobs.owed_days(spark, layers["datamart"], "dmart_user_book") == later
    monkeypatch.undo()
    jobs.run_marts(spark, layers)
    assert not any(jobs.owed_days(spark, layers["datamart"], name) for name in jobs.MARTS)
    assert stored_marts(spark, layers) == expected_marts(spark, layers)
    # what every mart has settled is cleared away
    assert spark.table(f"{layers['datamart']}.{jobs.OWED}").isEmpty()
    assert spark.table(f"{layers['datamart']}.{jobs.SETTLED}").isEmpty()


def test_failure_of_one_model_reaches_the_caller():
    done = []
    with pytest.raises(KeyError):
        jobs._side_by_side(lambda: {}["x"], lambda: done.append(1))
    assert done == [1]
