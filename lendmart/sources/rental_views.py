"""Library tables derived from an order-entry schema.

Customers become users, parts become books, and order lines become rentals.
Every source row takes part. Some rentals point at closed accounts or withdrawn
titles (negative numbers), so that unmatched keys occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import Hot, hot_keys
from ..schemas import METRIC_LABELS
from .readers import read_pages

# How codes of the source map to the library's categories.
_TYPE_BY_SIZE = ("Novel", "Comic", "Biography", "Encyclopedia", "Magazine")
_GENRE_BY_PART = {
    "ECONOMY": "Fiction", "SMALL": "Non-Fiction", "MEDIUM": "Mystery",
    "PROMO": "Thriller", "STANDARD": "Romance",
}
_OTHER_GENRE = "Technology"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined_on(start: str, key: str) -> Column:
    """A creation time within the year after ``start``."""
    return F.to_timestamp_ntz(F.lit(start)) + F.make_dt_interval(
        F.pmod(F.col(key), F.lit(365)).cast("int")
    )


def users(spark: SparkSession, sf_dir: str, shared_email: bool = False) -> DataFrame:
    """Users; with ``shared_email`` those of one segment, nation and wealth have one email."""
    handle = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
    if shared_email:
        handle = F.concat_ws(
            ".", F.lower("c_mktsegment"), F.col("c_nationkey").cast("string"),
            F.floor(F.col("c_acctbal") / 1000).cast("string"),
        )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(handle, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("address"),
        F.when(F.col("c_acctbal") < 0, F.lit(None))
        .when(F.col("c_nationkey") % 2 == 0, F.lit("Male"))
        .otherwise(F.lit("Female")).alias("gender"),
        _joined_on("1995-01-01 08:00:00", "c_custkey").alias("created_at"),
    )


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(
        F.array(*map(F.lit, _TYPE_BY_SIZE)), F.pmod(F.col("p_size"), F.lit(5)) + 1
    )
    genre = F.lit(_OTHER_GENRE)
    for code, name in _GENRE_BY_PART.items():
        genre = F.when(F.col("p_type") == code, F.lit(name)).otherwise(genre)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("book_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"),
        kind.alias("book_type"),
        genre.alias("genre"),
        F.concat(F.lit("Publisher of "), F.col("p_brand")).alias("publisher"),
        (2000 + F.col("p_size") % 24).cast("long").alias("release_year"),
        (1 + F.col("p_size") % 10).cast("long").alias("stock"),
        _joined_on("1995-01-01 09:00:00", "p_partkey").alias("created_at"),
    )


def rent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as they come; their rent numbers repeat."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("rent_id"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate",
    )


def rents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rental per (order, line number).

    Lines are aggregated before the join: that takes a map-side step, so an
    order with very many lines reaches the join as at most seven rows.
    """
    lines = (
        rent_lines(spark, sf_dir)
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_partkey").alias("part"),
            F.min("l_quantity").alias("quantity"),
            # A number, not the letter: text minima and maxima cannot be hash-aggregated.
            F.max(F.ascii("l_returnflag")).alias("flag"),
            F.max("l_shipdate").alias("shipped"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"
    )
    closed = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    withdrawn = F.col("quantity") >= 49

    def reference(number: str, gone: Column) -> Column:
        return F.when(gone, -1 - F.col(number)).otherwise(F.col(number))

    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("rent_id"),
        reference("o_custkey", closed).alias("user_id"),
        reference("part", withdrawn).alias("book_id"),
        F.col("o_orderdate").alias("rent_date"),
        F.when(F.col("flag") != ord("N"), F.col("shipped") + F.expr("INTERVAL '17' HOUR"))
        .alias("return_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL '45 10' DAY TO HOUR")).alias("created_at"),
    )


def hot_references(spark: SparkSession, sf_dir: str) -> dict[str, Hot]:
    """Users and books that very many rentals may name, from two key columns.

    Order and line counts stand in for rental counts; a wrong guess costs time,
    never rows. A frequent number may also occur as a negative reference.
    """
    owners = hot_keys(table(spark, sf_dir, "orders"), "o_custkey")["o_custkey"]
    parts = hot_keys(table(spark, sf_dir, "lineitem"), "l_partkey")["l_partkey"]

    def both(hot: Hot) -> Hot:
        return hot._replace(values=hot.values + tuple(-1 - v for v in hot.values))

    return {"user_id": both(owners), "book_id": both(parts)}


def card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored pages, each with a block of metric cards ahead of its markup.

    The figures follow from ``page_id``. Every ninth page lacks the last card;
    some repeat the first card later, readable or not.
    """
    def card(label: str, value: Column) -> Column:
        return F.concat(
            F.lit(f'<div class="col-md-3 col-12">\n<b><p> {label} </p><br><h5> '), value,
            F.lit(" </h5></div>"),
        )

    suffix = (".5 Ribu", " M", "")
    parts = []
    for k, label in enumerate(METRIC_LABELS):
        base = (F.col("page_id") * (k + 1)) % 97
        shown = card(label, F.concat(base.cast("string"), F.lit(suffix[k % 3])))
        if k == len(METRIC_LABELS) - 1:
            shown = F.when(F.col("page_id") % 9 == 0, F.lit("")).otherwise(shown)
        parts.append(shown)
    again = F.col("page_id") % 7
    parts.append(
        F.when(again == 3, card(METRIC_LABELS[0], F.lit("n/a")))
        .when(again == 5, card(METRIC_LABELS[0], F.lit("7 M")))
        .otherwise(F.lit(""))
    )
    parts.append(card("Unlisted figure", F.lit("1")))
    return read_pages(spark, f"{sf_dir}/pages.parquet").select(
        "page_id",
        F.concat(F.lit("<section>"), *parts, F.lit("</section>"), F.col("html")).alias("html"),
        (F.to_timestamp_ntz(F.lit("2025-02-08 03:00:00"))
         + F.make_dt_interval(F.col("page_id").cast("int"))).alias("created_at"),
    )
