"""Models on hand-made rows, one case per trap, and against plain SQL joins."""

from __future__ import annotations

import pytest

from conftest import at, rows
from lendmart.functions.scalars import rental_days
from lendmart.operators.joins import Hot, hot_keys
from lendmart.operators.quality import constraint_report, fk_orphans
from lendmart.plans import datamart, dimfact, preparation
from lendmart.plans.dimfact import FACT_COLUMNS

RENT = "rent_id long, user_id long, book_id long, rent_date timestamp_ntz, " \
       "return_date timestamp_ntz, created_at timestamp_ntz"
USER = "user_id long, name string, email string, gender string, created_at timestamp_ntz"
BOOK = "book_id long, title string, author string, book_type string, genre string, " \
       "release_year long, stock long, created_at timestamp_ntz"
NOON = at("2025-01-10 12:00:00")


def build(spark, rents, users, books):
    """Inputs of the marts from short rows."""
    inputs = {
        "prep_rents": spark.createDataFrame(
            [(i, u, b, None, back, made or NOON) for i, (u, b, back, made) in enumerate(rents)], RENT),
        "dim_users": spark.createDataFrame([(i, f"n{i}", f"e{i}", g, None) for i, g in users], USER),
        "dim_books": spark.createDataFrame(
            [(i, "t", "a", kind, genre, 2001, stock, None) for i, kind, genre, stock in books], BOOK),
    }
    inputs["fact_rents"] = dimfact.fact_rents(inputs)
    return inputs


def test_whole_days_and_calendar_days(spark):
    df = spark.createDataFrame(
        [(at("2025-01-02 01:00:00"), at("2025-01-01 23:00:00")),
         (at("2025-01-01 00:00:00"), at("2025-01-05 00:00:00")),
         (at("2025-01-05 00:00:00"), None), (None, at("2025-01-05 00:00:00"))],
        "c timestamp_ntz, r timestamp_ntz",
    )
    got = df.select(rental_days("c", "r"), rental_days("c", "r", calendar=True)).collect()
    assert [tuple(r) for r in got] == [(0, 1), (0, 0), (None, None), (None, None)]


def test_prep_projections(spark):
    users = spark.createDataFrame(
        [(1, "n", "e", "street", "Male", NOON)],
        "user_id long, name string, email string, address string, gender string, "
        "created_at timestamp_ntz")
    assert preparation.prep_users({"users": users}).columns == [
        "user_id", "name", "email", "gender", "created_at"]
    assert preparation.prep_rents({"rents": users}) is users


def test_fact_takes_keys_from_the_dimensions(spark):
    inputs = build(spark, [(1, 1, None, None), (1, 9, None, None), (9, 1, None, None)],
                   [(1, "Male")], [(1, "Novel", "Fiction", 5)])
    fact = inputs["fact_rents"]
    assert fact.columns == list(FACT_COLUMNS)
    assert rows(fact.select("rent_id", "user_id", "book_id", "gender", "genre")) == [
        (0, 1, 1, "Male", "Fiction"), (1, 1, None, "Male", None), (2, None, 1, None, "Fiction")]


def test_missing_return_is_left_out_of_the_mean(spark):
    back = at("2025-01-06 12:00:00")
    inputs = build(spark, [(1, 1, None, None), (1, 1, back, None), (2, 1, None, None)],
                   [(1, "Male"), (2, None)], [(1, "Novel", "Fiction", 5)])
    mart = datamart.dmart_user_book(inputs)
    assert dict(mart.dtypes)["avg_rent_duration"] == "double"
    assert rows(mart.select("user_id", "sum_of_book", "avg_rent_duration")) == [
        (1, 2, 4.0), (2, 1, 0.0)]


def test_unmatched_book_is_a_group_without_rentals(spark):
    inputs = build(spark, [(1, 9, None, None)], [(1, "Male")], [(1, "Novel", "Fiction", 5)])
    assert rows(datamart.dmart_user_book(inputs).select("user_id", "sum_of_book")) == [(1, 0)]
    assert rows(datamart.dmart_gender_book(inputs).select("book_type", "total_rentals")) == [(None, 0)]
    stock = datamart.dmart_booktype_stock(inputs)
    assert rows(stock.select("book_type", "total_rent_per_type", "stock_book_per_type", "sisa_stock")
                ) == [(None, 0, None, 0)]


def test_unlisted_genre_counts_in_the_total_only(spark):
    inputs = build(spark, [(1, 1, None, None), (1, 2, None, None), (1, 2, None, None)],
                   [(1, "Male")], [(1, "Novel", "Fiction", 1), (2, "Novel", "Poetry", None)])
    row = datamart.dmart_booktype_stock(inputs).first().asDict()
    assert row["Fiction"] == 1 and row["Non-Fiction"] == 0
    assert row["total_rent_per_type"] == 3
    assert row["stock_book_per_type"] == 1 and row["sisa_stock"] == -2


def test_shares_per_gender(spark):
    inputs = build(
        spark,
        [(1, 1, None, None)] + [(2, 1, None, None)] * 2 + [(3, 2, None, None)] * 3
        + [(1, 3, None, None), (1, 4, None, None)],
        [(1, "Female"), (2, "Male"), (3, None)],
        [(1, "Novel", "Fiction", 1), (2, "Comic", "Fiction", 1), (3, None, "Fiction", 1),
         (4, "Comic", None, 1)],
    )
    assert rows(datamart.dmart_book_gender(inputs)) == [
        ("Comic", "Fiction", None, 3, 3, 100.0),
        ("Novel", "Fiction", "Female", 1, 3, 33.33), ("Novel", "Fiction", "Male", 2, 3, 66.67)]


def _by_sql(spark, inputs, mart):
    """The marts as single SQL statements of plain joins and one aggregation."""
    for name in ("fact_rents", "dim_users", "dim_books"):
        inputs[name].createOrReplaceTempView(name)
    joins = """FROM fact_rents f LEFT JOIN dim_users u ON f.user_id = u.user_id
               LEFT JOIN dim_books b ON f.book_id = b.book_id"""
    return spark.sql({
        "dmart_user_book": f"""
            SELECT f.user_id, f.user_name, u.email, u.gender, count(f.book_id),
                   coalesce(cast(ceil(avg(CASE WHEN return_date IS NOT NULL THEN greatest(
                     timestampdiff(DAY, return_date, f.created_at), 0) END)) AS double), 0D),
                   cast(f.created_at AS date)
            {joins} GROUP BY f.user_id, f.user_name, u.email, u.gender, cast(f.created_at AS date)""",
        "dmart_gender_book": f"""
            SELECT u.gender, b.book_type, b.genre, count(f.book_id), cast(f.created_at AS date)
            {joins} GROUP BY u.gender, b.book_type, b.genre, cast(f.created_at AS date)""",
        "dmart_booktype_stock": """
            WITH n AS (SELECT b.book_type, b.genre, count(f.book_id) AS n FROM fact_rents f
                       LEFT JOIN dim_books b ON f.book_id = b.book_id GROUP BY ALL),
            s AS (SELECT book_type, sum(stock) AS held FROM dim_books GROUP BY book_type)
            SELECT n.book_type,
                   coalesce(sum(n) FILTER (WHERE genre = 'Non-Fiction'), 0),
                   coalesce(sum(n) FILTER (WHERE genre = 'Fiction'), 0),
                   coalesce(sum(n) FILTER (WHERE genre = 'Mystery'), 0),
                   coalesce(sum(n) FILTER (WHERE genre = 'Thriller'), 0),
                   coalesce(sum(n) FILTER (WHERE genre = 'Romance'), 0),
                   coalesce(sum(n) FILTER (WHERE genre = 'Technology'), 0),
                   coalesce(sum(n), 0), held, coalesce(held, 0) - coalesce(sum(n), 0)
            FROM n LEFT JOIN s ON n.book_type = s.book_type GROUP BY n.book_type, held""",
    }[mart])


def _hot_inputs(spark):
    """A third of the rentals on one user and one book; dimensions with repeats."""
    rents = spark.range(3000).selectExpr(
        "id AS rent_id",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 40 END AS user_id",
        "CASE WHEN id % 3 = 1 THEN 2 ELSE id % 50 END AS book_id",
        "CAST(NULL AS timestamp_ntz) AS rent_date",
        "CASE WHEN id % 4 > 0 THEN timestamp_ntz'2025-01-01 00:00:00' "
        "  + make_dt_interval(cast(id % 7 AS int)) END AS return_date",
        "timestamp_ntz'2025-01-03 10:00:00' + make_dt_interval(cast(id % 5 AS int)) AS created_at",
    )
    # Users 30.. and books 45.. are unknown; some numbers occur twice or three times.
    users = spark.range(35).selectExpr(
        "CASE WHEN id >= 30 THEN id - 30 ELSE id END AS user_id",
        "concat('n', id % 30) AS name",
        "CASE WHEN id = 31 THEN 'other' ELSE concat('e', id % 30) END AS email",
        "CASE WHEN id % 30 % 3 = 0 THEN 'Male' WHEN id % 30 % 3 = 1 THEN 'Female' END AS gender",
        "CAST(NULL AS timestamp_ntz) AS created_at",
    )
    books = spark.range(52).selectExpr(
        "CASE WHEN id >= 45 THEN id % 4 ELSE id END AS book_id", "'t' AS title", "'a' AS author",
        "CASE WHEN id % 4 = 3 THEN NULL ELSE concat('type', id % 4) END AS book_type",
        "element_at(array('Fiction', 'Non-Fiction', 'Poetry'), cast(id % 3 + 1 AS int)) AS genre",
        "2001L AS release_year", "id AS stock", "CAST(NULL AS timestamp_ntz) AS created_at",
    )
    inputs = {"prep_rents": rents, "dim_users": users, "dim_books": books}
    inputs["fact_rents"] = dimfact.fact_rents(inputs)
    return inputs


@pytest.mark.parametrize("mart", ["dmart_user_book", "dmart_gender_book", "dmart_booktype_stock"])
@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_marts_equal_plain_joins(spark, mart, broadcast):
    inputs = _hot_inputs(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        model = getattr(datamart, mart)
        if mart == "dmart_gender_book":
            got = model(inputs, Hot((1, 5), True))
        else:
            got = model(inputs)
        expected = _by_sql(spark, inputs, mart)
        assert rows(got) == rows(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_many_repeated_books_equal_plain_joins(spark):
    inputs = _hot_inputs(spark)
    hot = hot_keys(inputs["fact_rents"], "book_id")["book_id"]
    assert 2 in hot.values
    got = datamart.dmart_user_book(inputs, hot=hot)
    assert rows(got) == rows(_by_sql(spark, inputs, "dmart_user_book"))


def test_fact_with_hot_keys_is_the_same(spark):
    inputs = _hot_inputs(spark)
    hot = hot_keys(inputs["prep_rents"], "user_id", "book_id")
    assert 1 in hot["user_id"].values and 2 in hot["book_id"].values
    plain, spread = dimfact.fact_rents(inputs), dimfact.fact_rents(inputs, hot)
    assert plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()


def test_totals_agree_between_marts(spark):
    inputs = build(
        spark, [(i % 5, i % 7, None, None) for i in range(60)],
        [(i, "Male" if i % 2 else "Female") for i in range(4)],
        [(i, "Novel", "Fiction" if i % 2 else "Romance", 3) for i in range(6)])
    total = inputs["fact_rents"].where("book_id IS NOT NULL").count()
    for model, column in ((datamart.dmart_user_book, "sum_of_book"),
                          (datamart.dmart_gender_book, "total_rentals"),
                          (datamart.dmart_booktype_stock, "total_rent_per_type")):
        assert model(inputs).groupBy().sum(column).first()[0] == total
    shares = datamart.dmart_book_gender(inputs).groupBy("book_type", "genre").sum(
        "percentage_per_gender")
    assert all(abs(r[2] - 100) < 0.05 for r in shares.collect())


def test_presentation_order(spark):
    df = spark.createDataFrame(
        [("Male", 1), (None, 2), ("Female", 3), ("Female", 9)], "gender string, total_rentals long")
    shown = datamart.shown("dmart_gender_book", df).collect()
    assert [tuple(r) for r in shown] == [(None, 2), ("Female", 9), ("Female", 3), ("Male", 1)]


def test_constraint_report_shuffles_once(spark):
    schema = "user_id long, name string, email string, gender string"
    users = spark.createDataFrame([(1, "a", "e", "x" * 11), (1, None, "e", None), (None, "b", None, "f"), (2, "c", "e", "f")], schema)
    books = spark.createDataFrame([(1, "t", "a", "Novel", "g", "p", 1)], "book_id long, title string, author string, book_type string, genre string, publisher string, stock long")
    report = constraint_report({"users": users, "books": books})
    found = {(r.table_name, r.column_name, r.rule): r.violations for r in report.collect()}
    broken = {("users", "user_id", "not_null"): 1, ("users", "name", "not_null"): 1, ("users", "email", "not_null"): 1,
              ("users", "gender", "max_length_10"): 1, ("users", "user_id", "primary_key"): 1, ("users", "email", "unique"): 2}
    assert {k: v for k, v in found.items() if v} == broken and len(found) == 8 + 10
    plan = report._jdf.queryExecution().sparkPlan().toString()
    whole = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert whole.count("Exchange hashpartitioning(rule") == 2 and whole.count("high#") and "Window" not in plan


def test_constraint_report(spark):
    users = spark.createDataFrame(
        [(1, "n", "a@x", "st", "Male"), (1, None, "a@x", "st", "Unspecified"),
         (None, "n" * 101, None, "st", None)],
        "user_id long, name string, email string, address string, gender string")
    report = {(r.column_name, r.rule): r.violations
              for r in constraint_report({"users": users}).collect()}
    assert report == {
        ("user_id", "not_null"): 1, ("name", "not_null"): 1, ("email", "not_null"): 1,
        ("name", "max_length_100"): 1, ("email", "max_length_100"): 0,
        ("gender", "max_length_10"): 1, ("user_id", "primary_key"): 1, ("email", "unique"): 1,
    }


def test_report_on_empty_tables(spark):
    empty = spark.createDataFrame([], RENT)
    assert {r.violations for r in constraint_report({"rents": empty}).collect()} == {0}


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    parent = spark.createDataFrame([(1,), (1,), (3,)], "k long")
    assert rows(fk_orphans(child, parent, "k")) == [("k", 2, 2)]
