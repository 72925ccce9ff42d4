"""Late rows: digests per day, repairs, streams that keep late rows or drop redeliveries."""

from __future__ import annotations

import time
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import at, rows
from lendmart.operators import digests
from lendmart.operators.merge import rows_after
from lendmart.plans import layers as jobs, repair
from lendmart.session import shared_folder
from lendmart.sources import landing
from lendmart.streaming import jobs as streams, late_counts

ROW = "k long, v string, created_at timestamp_ntz"
D = [at(f"2025-01-0{d} 10:00:00") for d in range(1, 10)]


def found(df):
    return {r["day"]: (r["source_rows"], r["target_rows"]) for r in df.collect()}


# --- digests -----------------------------------------------------------------------------
def test_digests_see_rows_not_order(spark):
    one = spark.createDataFrame([(1, "a", D[0]), (2, None, D[0]), (3, "c", D[1]), (4, "d", None)], ROW)
    same = one.orderBy(F.desc("k")).repartition(3)
    digest = lambda df: digests.day_digests(df, ["k", "v"])
    assert found(digests.differing_days(digest(one), digest(same))) == {}
    moved = spark.createDataFrame([(1, "a", D[0]), (None, "2", D[0]), (3, "c", D[2]), (4, "d", None), (4, "d", None)], ROW)
    assert found(digests.differing_days(digest(one), digest(moved))) == {
        date(2025, 1, 1): (2, 2), date(2025, 1, 2): (1, 0), date(2025, 1, 3): (0, 1), None: (1, 2)}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", None, "b"]), st.sampled_from([*D[:3], None])), max_size=12),
       st.integers(0, 12))
def test_digests_of_parts_add_up(spark, data, cut):
    frame = lambda part: spark.createDataFrame(part, ROW)
    whole = digests.day_digests(frame(data), ["k", "v"])
    parts = digests.combined_digests(*(digests.day_digests(frame(p), ["k", "v"]) for p in (data[:cut], data[cut:])))
    assert rows(whole) == rows(parts)


# --- repairs ------------------------------------------------------------------------------
def test_repair_reloads_exactly_the_skipped_days(spark, database):
    table = f"{database}.t"
    first = [(1, "a", D[0]), (2, "b", D[1]), (3, "c", D[2])]
    landing.write_partitioned(spark.createDataFrame(first, ROW), table)
    repair.note_digests(spark, table, ["k", "created_at"])
    source = spark.createDataFrame(
        [*first, (4, "late", D[0]), (5, "tied", D[2]), (6, "no time", None), (7, "new", D[4]), (2, "b", D[1])][:7], ROW)
    mark = landing.stored_watermark(spark, table)
    assert tuple(repair.left_out(source, mark).first()) == (3, 2, 1)  # rows the delta does not look at
    delta = rows_after(source, mark)
    landing.write_partitioned(delta, table, mode="append")
    repair.absorb_digests(spark, table, delta, ["k", "created_at"])

    assert found(repair.skipped_days(spark, source, table, ["k", "created_at"])) == {
        date(2025, 1, 1): (2, 1), date(2025, 1, 3): (2, 1), None: (1, 0)}
    before = {d: spark.table(table).where(landing.on_days("created_date", {d})).inputFiles() for d in (date(2025, 1, 2), date(2025, 1, 5))}
    assert repair.repair_table(spark, source, table, "k") == {date(2025, 1, 1), date(2025, 1, 3), None}
    assert rows(landing.stored(spark, table)) == rows(source)
    for day, files in before.items():  # other days were not written
        assert spark.table(table).where(landing.on_days("created_date", {day})).inputFiles() == files
    assert repair.repair_table(spark, source, table, "k") == set()


def test_repair_drops_days_the_source_lost_and_can_see_changes_in_place(spark, database):
    table = f"{database}.t"
    landing.write_partitioned(spark.createDataFrame([(1, "a", D[0]), (2, "b", D[1]), (3, "c", None)], ROW), table)
    source = spark.createDataFrame([(2, "B", D[1])], ROW)
    assert repair.repair_table(spark, source, table, "k") == {date(2025, 1, 1), None}
    assert rows(landing.stored(spark, table)) == [(2, "b", D[1])]
    landing.drop_table(spark, repair.digest_table(table))
    assert repair.repair_table(spark, source, table, "k", identity=["k", "v", "created_at"]) == {date(2025, 1, 2)}
    assert rows(landing.stored(spark, table)) == rows(source)


def test_repair_reaches_fact_and_marts(spark, layers):
    from test_jobs import expected_marts, source, stored_marts

    tables = source(spark)
    held = {"users": tables["users"].where("user_id <> 1"), "rents": tables["rents"].where("rent_id not in (2, 4)")}
    jobs.run_layers(spark, tables | held, layers)
    jobs.run_layers(spark, tables, layers)  # rental 2 is late; 4 is newer and taken
    fact = landing.stored(spark, f"{layers['dimfact']}.fact_rents")
    assert rows(fact.select("rent_id", "user_id")) == [(1, None), (3, 3), (4, 2)]
    done = repair.repair_layers(spark, tables, layers)
    first = date(2025, 1, 1)
    assert done == {"prep_users": {first}, "prep_books": set(), "prep_rents": {first}, "dim_users": {first},
                    "dim_books": set(), "fact_rents": {first}}
    assert rows(landing.stored(spark, f"{layers['dimfact']}.fact_rents").select("rent_id", "user_id")) == [
        (1, 1), (2, 3), (3, 3), (4, 2)]
    assert jobs.owed_days(spark, layers["datamart"], "dmart_user_book") == {first}
    jobs.run_marts(spark, layers)
    assert stored_marts(spark, layers) == expected_marts(spark, layers)
    assert not any(repair.repair_layers(spark, tables, layers).values())


# --- insert-only stream with a bounded state ---------------------------------------------------
def deliver(spark, folder, data, schema=ROW):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)


def test_redeliveries_cost_no_read_of_the_target(spark, database, monkeypatch):
    folder, table, marks = (shared_folder(spark, n) for n in ("in", "t", "marks"))
    table = f"{database}.t"
    reads = []
    known = streams.append_new_rows
    monkeypatch.setattr(streams, "append_new_rows", lambda batch, *a: (reads.append(batch.count()), known(batch, *a)))

    def run():
        source = streams.stream_files(spark, folder, spark.createDataFrame([], ROW).schema, files=1)
        query = streams.stream_insert_only(source, table, "k", marks, within="1 hour")
        query.awaitTermination()
        return query

    first = [(1, "a", D[0]), (1, "a", D[0]), (2, None, D[1]), (None, "n", D[2])]
    deliver(spark, folder, first)
    deliver(spark, folder, first)
    query = run()
    plan = query._jsq.explainInternal(False)
    assert "StreamingDeduplicateWithinWatermark" in plan
    assert query.lastProgress["stateOperators"][0]["operatorName"] == "dedupeWithinWatermark"
    deliver(spark, folder, [*first, (2, "other", D[1]), (3, "c", D[0])])  # late by its own time, and not lost
    run()
    assert reads == [3, 2]  # the second delivery reached no merge, of the third its new rows did
    assert rows(landing.stored(spark, table)) == rows(spark.createDataFrame(
        [(1, "a", D[0]), (2, None, D[1]), (None, "n", D[2]), (3, "c", D[0])], ROW))


def test_state_of_redeliveries_is_bounded(spark, database):
    folder, marks = shared_folder(spark, "in"), shared_folder(spark, "marks")
    schema = spark.createDataFrame([], ROW).schema
    kept = []
    for round_ in range(5):
        deliver(spark, folder, [(round_ * 50 + k, "v", D[0]) for k in range(50)])
        query = streams.stream_insert_only(
            streams.stream_files(spark, folder, schema), f"{database}.t", "k", marks, within="1 second")
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(1.5)
    assert max(kept) <= 100 and landing.stored(spark, f"{database}.t").count() == 250


# --- counts with late rows ----------------------------------------------------------------------
EVENT = "id long, kind string, ts timestamp_ntz"
BATCHES = [
    [(1, "a", "2025-01-01 10:00:00"), (2, "b", "2025-01-01 11:00:00"), (3, "a", "2025-01-02 01:00:00")],
    [(4, "a", "2025-01-04 00:30:00"), (5, None, "2025-01-02 02:00:00")],  # passes days 1 and 2 from here on
    [(6, "a", "2025-01-01 12:00:00"), (7, "c", "2025-01-02 03:00:00"), (8, "a", None), (9, "b", "2025-01-03 05:00:00")],
    [(10, "a", "2025-01-06 00:00:00"), (11, "b", "2025-01-02 09:00:00")],
]


def run_counts(spark, database, upto=len(BATCHES), folder=None, marks=None):
    folder, marks = folder or shared_folder(spark, "in"), marks or shared_folder(spark, "marks")
    schema = spark.createDataFrame([], EVENT).schema
    for batch in BATCHES[:upto]:
        deliver(spark, folder, [(i, kind, t and at(t)) for i, kind, t in batch], EVENT)
        late_counts.stream_counts_with_late(
            streams.stream_files(spark, folder, schema), f"{database}.c", "ts", ["kind"], marks, "1 day", "n",
        ).awaitTermination()


def counts(spark, table):
    return {(str(r["day"]), r["kind"]): r["n"] for r in spark.table(table).collect()}


def test_counts_and_late_rows_make_the_whole(spark, database):
    run_counts(spark, database)
    table = f"{database}.c"
    on_time = {("2025-01-01", "a"): 1, ("2025-01-01", "b"): 1, ("2025-01-02", "a"): 1, ("2025-01-02", None): 1,
               ("2025-01-03", "b"): 1, ("2025-01-04", "a"): 1}
    assert counts(spark, table) == on_time
    late = {(str(r["day"]), r["late_rows"]) for r in late_counts.late_report(spark, table).collect()}
    assert late == {("2025-01-01", 1), ("2025-01-02", 2), ("None", 1)}
    for _ in range(2):  # merging again changes nothing
        assert late_counts.merge_late(spark, table, ["kind"], "n") == {date(2025, 1, 1), date(2025, 1, 2)}
        assert counts(spark, table) == on_time | {
            ("2025-01-01", "a"): 2, ("2025-01-02", "c"): 1, ("2025-01-02", "b"): 1}


@pytest.mark.parametrize("step", ["open", "late", "on_time", "marks"])
def test_a_batch_that_failed_anywhere_counts_once(spark, database, monkeypatch, step):
    folder, marks = shared_folder(spark, "in"), shared_folder(spark, "marks")
    run_counts(spark, database, 2, folder, marks)
    put = late_counts.put_parts

    def failing(df, table, by):
        put(df, table, by)
        if table.endswith(f"__{step}"):
            raise RuntimeError("lost")

    batch = [(i, kind, t and at(t)) for i, kind, t in BATCHES[2]] + [(20, "a", at("2025-01-08 00:00:00"))]
    take = lambda: late_counts.count_batch(
        spark.createDataFrame(batch, EVENT), 2, f"{database}.c", "ts", ["kind"], "1 day", "n")
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(late_counts, "put_parts", failing)
        take()
    take()
    assert counts(spark, f"{database}.c") == {
        ("2025-01-01", "a"): 1, ("2025-01-01", "b"): 1, ("2025-01-02", "a"): 1, ("2025-01-02", None): 1,
        ("2025-01-03", "b"): 1, ("2025-01-04", "a"): 1}
    assert spark.table(f"{database}.c__late").count() == 3


def test_deliveries_are_written_by_all_tasks(spark, tmp_path):
    import __spark_entry__ as entry

    spark.range(100, numPartitions=4).selectExpr("id AS event_id").write.parquet(str(tmp_path / "events.parquet"))
    (_, stream), = entry._deliveries(spark, str(tmp_path), lambda e: e.repartition(4))
    batches = []
    named = stream.selectExpr("event_id", "input_file_name() AS file")
    named.writeStream.foreachBatch(
        lambda rows, _: batches.append((rows.count(), rows.select("file").distinct().count()))
    ).option(
        "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert sum(n for n, _ in batches) == 100 and len(batches) == 1 and batches[0][1] > 1
