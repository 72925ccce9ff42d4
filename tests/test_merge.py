"""Merges, also against a row-by-row rendition in Python."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from conftest import at, rows
from lendmart.operators import merge
from lendmart.operators.joins import Hot, hot_keys, spread_join
from lendmart.sources import landing

ROW = "k long, v string, created_at timestamp_ntz"
T0, T1, T2 = at("2025-01-01 00:00:00"), at("2025-01-02 00:00:00"), at("2025-01-03 00:00:00")


def frame(spark, data, schema=ROW):
    return spark.createDataFrame(data, schema)


def test_insert_only(spark):
    target = frame(spark, [(1, "a", T0), (None, "n", T0)])
    staging = frame(spark, [(1, "z", T1), (2, "b", T1), (2, "b", T1), (2, "c", T1),
                            (None, "n", T1), (9, "late", None)])
    merged = merge.insert_only_merge(target, staging, "k")
    assert rows(merged) == sorted(
        [(1, "a", T0), (None, "n", T0), (2, "b", T1), (2, "c", T1), (None, "n", T1)],
        key=lambda r: tuple((x is not None, x) for x in r),
    )


def test_insert_only_twice_is_once(spark):
    target = frame(spark, [(1, "a", T0)])
    staging = frame(spark, [(1, "z", T1), (2, "b", T1)])
    once = merge.insert_only_merge(target, staging, "k")
    assert rows(merge.insert_only_merge(once, staging, "k")) == rows(once)


def test_watermark(spark):
    src = frame(spark, [(1, "late", T0), (2, "tie", T1), (3, "new", T2), (4, "none", None)])
    target = frame(spark, [(0, "x", T1)])
    assert [r.k for r in merge.watermark_delta(src, target).collect()] == [3]
    assert merge.watermark_delta(src, None).count() == 4
    empty = target.limit(0)
    assert merge.watermark_delta(src, empty).count() == 4
    assert merge.watermark_delta(src, empty, strict=True).count() == 0


def test_upsert_replaces_and_inserts(spark):
    target = frame(spark, [(1, "a", T0), (2, "b", T0), (None, "n", T0)])
    delta = frame(spark, [(2, "B", T1), (3, "C", T1), (None, "N", T1)])
    assert sorted(r.v for r in merge.upsert(target, delta, "k").collect()) == list("BCNan")
    safe = merge.upsert(target, delta, "k", null_safe=True)
    assert sorted(r.v for r in safe.collect()) == list("BCNa")
    assert rows(merge.upsert(target, delta.limit(0), "k")) == rows(target)


def test_null_keys_pile_up_only_by_default(spark):
    row = frame(spark, [(None, "n", T0)])
    for null_safe, count in ((False, 2), (True, 1)):
        assert merge.upsert(row, row, ["k"], null_safe).count() == count


def test_ambiguous_delta(spark):
    delta = frame(spark, [(1, "a", T0), (1, "b", T0)])
    with pytest.raises(merge.AmbiguousMerge):
        merge.assert_unique(delta, "k")
    nulls = frame(spark, [(None, "a", T0), (None, "b", T0)])
    assert merge.assert_unique(nulls, "k") is nulls
    with pytest.raises(merge.AmbiguousMerge):
        merge.assert_unique(nulls, "k", null_safe=True)


def test_insert_ignore_keeps_the_first(spark):
    schema = "user_id long, email string, name string"
    target = frame(spark, [(1, "a@x", "A")], schema)
    batch = frame(spark, [(5, "b@x", "late"), (2, "a@x", "taken"), (3, "b@x", "first"),
                          (4, None, "none"), (6, None, "none")], schema)
    merged = merge.insert_ignore(target, batch, "email", "user_id")
    assert sorted(r.user_id for r in merged.collect()) == [1, 3, 4, 6]


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(-2, 2)),
                          st.sampled_from(["x", "y"])), max_size=14), st.booleans())
def test_insert_ignore_against_brute_force(spark, batch, by_text):
    """Also with ties, NULL orders and repeated rows; NULLs come first."""
    schema = "email string, n long, name string"
    target = [("c", 9, "t")]
    got = merge.insert_ignore(frame(spark, target, schema), frame(spark, batch, schema), "email",
                              ["name", "n"] if by_text else "n").collect()
    got = sorted(map(tuple, got), key=str)
    nulls = [r for r in batch if r[0] is None]
    assert sorted([r for r in got if r[0] is None], key=str) == sorted(nulls, key=str)
    order = lambda r: (r[2], r[1] is not None, r[1] or 0) if by_text else (r[1] is not None, r[1] or 0)
    for email in ("a", "b"):
        mine = [r for r in batch if r[0] == email]
        kept = [r for r in got if r[0] == email]
        assert len(kept) == bool(mine)
        if mine:
            assert kept[0] in mine and order(kept[0]) == min(map(order, mine))
    assert [r for r in got if r[0] == "c"] == target


def test_insert_ignore_needs_no_sort(spark):
    schema = "user_id long, email string, name string"
    rows_ = frame(spark, [(k, f"e{k % 3}", "n") for k in range(9)], schema)
    merged = merge.insert_ignore(rows_.limit(1), rows_, "email", "user_id")
    merged.collect()
    assert "SortAggregate" not in merged._jdf.queryExecution().executedPlan().toString()


def test_stock(spark):
    books = frame(spark, [(1, 2), (2, 1), (3, 0), (4, None)], "book_id long, stock long")
    rents = frame(spark, [(1,), (2,), (2,), (9,), (None,)], "book_id long")
    left = merge.apply_stock_decrement(books, rents)
    assert rows(left) == [(1, 1), (2, -1), (3, 0), (4, None)]
    assert rows(merge.available_books(left)) == [(1, 1)]


keys = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(keys, keys, st.integers(0, 3)), max_size=12),
    st.lists(st.tuples(keys, keys, st.integers(4, 7)), max_size=12, unique_by=lambda r: r[:2]),
    st.booleans(),
)
def test_upsert_against_brute_force(spark, target, delta, null_safe):
    schema = "a long, b long, v long"

    def same(x, y):
        return x[:2] == y[:2] and (null_safe or None not in x[:2])

    expected = [t for t in target if not any(same(t, d) for d in delta)] + delta
    merged = merge.upsert(frame(spark, target, schema), frame(spark, delta, schema),
                          ["a", "b"], null_safe)
    assert rows(merged) == sorted(expected, key=lambda r: tuple((x is not None, x) for x in r))


# --- hot keys -------------------------------------------------------------------------
def skewed(spark, n=30_000):
    """A third of the rows share one key, and a tenth has none."""
    return spark.range(n).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE 100 + id % 5000 END AS k"
    )


def test_hot_keys_are_found(spark):
    found = hot_keys(skewed(spark), "k", "id")
    assert found["k"] == Hot((7,), True)
    assert not found["id"]


@pytest.mark.parametrize("how", ["left", "left_anti", "left_semi", "inner"])
def test_spread_join_equals_plain_join(spark, how):
    left = skewed(spark)
    right = spark.range(0, 3000).selectExpr("id + 5 AS k", "id AS w")
    plain = left.join(right, "k", how)
    spread = spread_join(left, right, "k", how, ["id"], hot_keys(left, "k")["k"])
    assert spread.columns == plain.columns
    assert plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()


def test_hot_rows_are_spread_over_tasks(spark):
    """Without the salt one task would join a third of all rows."""
    from pyspark.sql import functions as F

    left = skewed(spark)
    right = spark.range(0, 6000).selectExpr("id AS k", "id AS w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        plain = largest(left.join(right, "k", "left"))
        hot = hot_keys(left, "k")["k"]
        spread = largest(spread_join(left, right, "k", "left", ["id"], hot))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert plain > 10_000
    assert spread < 3_000


# --- stored tables --------------------------------------------------------------------------
def test_append_new_rows(spark, database):
    table = f"{database}.t"
    landing.append_new_rows(frame(spark, [(1, "a", T0), (2, "b", T1)]), table, "k")
    landing.append_new_rows(frame(spark, [(2, "z", T2), (3, "c", T2), (None, "n", T2)]), table, "k")
    landing.append_new_rows(frame(spark, []), table, "k")
    assert sorted(r.v for r in spark.table(table).collect()) == list("abcn")


def test_upsert_moves_rows_between_days(spark, database):
    table = f"{database}.t"
    landing.write_partitioned(
        frame(spark, [(1, "a", T0), (2, "b", T1), (3, "c", T1), (4, "d", None)]), table)
    # 1 moves away from a day it had alone, 2 from a day shared with 3, 4 from no day.
    delta = f"{database}.d"
    frame(spark, [(1, "A", T2), (2, "B", T2), (4, "D", T2), (5, "E", T2)]).write.saveAsTable(delta)
    touched = landing.upsert_table(spark.table(delta), table, ["k"])
    assert touched == {T0.date(), T1.date(), T2.date(), None}
    assert rows(landing.stored(spark, table)) == [
        (1, "A", T2), (2, "B", T2), (3, "c", T1), (4, "D", T2), (5, "E", T2)]
    days = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert days == {"created_date=2025-01-02", "created_date=2025-01-03"}
    landing.upsert_table(spark.table(delta), table, ["k"])
    assert spark.table(table).count() == 5


def test_upsert_leaves_other_days_alone(spark, database):
    table = f"{database}.t"
    landing.write_partitioned(frame(spark, [(1, "a", T0), (2, "b", T1)]), table)
    before = {r[0] for r in spark.table(table).where("k = 1").selectExpr("_metadata.file_name").collect()}
    frame(spark, [(2, "B", T1)]).write.saveAsTable(f"{database}.d")
    landing.upsert_table(spark.table(f"{database}.d"), table, ["k"])
    after = {r[0] for r in spark.table(table).where("k = 1").selectExpr("_metadata.file_name").collect()}
    assert before == after
    assert sorted(r.v for r in spark.table(table).collect()) == ["B", "a"]


def test_upsert_refuses_an_ambiguous_delta(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    delta = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(merge.AmbiguousMerge), merge.ambiguous():
        merge.upsert(target, delta, "k").collect()
    assert merge.upsert(target, delta, "k", checked=True).count() == 2


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_upsert_guard_rides_in_the_plan(spark, database, threshold):
    """No job while the plan is built, and both readers of the delta share one exchange."""
    import re

    target = spark.range(2000).selectExpr("id % 1500 AS k", "id AS v")
    delta = spark.range(40).selectExpr("id * 50 AS k", "-id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    tag = f"upsert{threshold}"
    try:
        spark.sparkContext.setJobGroup(tag, tag)
        merged = merge.upsert(target, delta, "k")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(tag)
        assert len(merged.collect()) == 2000 - (30 + 10) + 40
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    final = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Range (0, 40") == 1 and "ReusedExchange" in final
    assert not re.search("SortAggregate", final)


def test_stored_upsert_refuses_an_ambiguous_delta(spark, database):
    table = f"{database}.t"
    landing.write_partitioned(frame(spark, [(1, "a", T0), (2, "b", T1)]), table)
    before = rows(landing.stored(spark, table))
    frame(spark, [(1, "x", T2), (1, "y", T2)]).write.saveAsTable(f"{database}.d")
    with pytest.raises(merge.AmbiguousMerge):
        landing.upsert_table(spark.table(f"{database}.d"), table, ["k"])
    assert rows(landing.stored(spark, table)) == before


def test_null_safe_upsert_spreads_null_keys(spark):
    target = spark.range(500).selectExpr("CAST(NULL AS INT) AS k", "id AS v")
    delta = spark.createDataFrame([(None, -1), (2, -2)], "k int, v long")
    hot = merge.hot_composite(target, ["k"])
    assert len(hot.values) == 1  # the NULL pattern
    kept = merge.upsert(target, delta, "k", null_safe=True, hot=hot)
    assert sorted(r.v for r in kept.collect()) == [-2, -1]
    plain = merge.upsert(target, delta, "k", null_safe=True)
    assert sorted(r.v for r in plain.collect()) == [-2, -1]
    assert "pmod" in kept._jdf.queryExecution().executedPlan().toString()


def test_stored_upsert_shuffles_keys_only(spark):
    """Of a stored delta only the keys are dealt out; a key claimed twice still ends the run."""
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, wide string")
    delta = spark.createDataFrame([(2, "c"), (3, "d")], "k long, wide string")
    merged = merge.upsert(target, delta, ["k"], stored=True)
    assert {tuple(r) for r in merged.collect()} == {(1, "a"), (2, "c"), (3, "d")}
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan
    with pytest.raises(merge.AmbiguousMerge), merge.ambiguous():
        merge.upsert(target, delta.unionAll(delta), ["k"], stored=True).collect()
