"""Datamarts. Each one shrinks the fact by partial aggregation as early as it can.

The joins may repeat fact rows (a dimension need not be unique), and a count must
then count the repeats, as a plain join would. Where a mart aggregates ahead of a
join it therefore carries row counts along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import day_of, rental_days
from ..operators.joins import Hot, spread_join
from .preparation import Inputs

# The stock report's genre columns, in column order.
STOCK_GENRES = ("Non-Fiction", "Fiction", "Mystery", "Thriller", "Romance", "Technology")

def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0).cast("long"))


def _copies(fact: DataFrame, books: DataFrame, hot: Hot) -> DataFrame:
    """The fact with ``_n``, how many rows of ``books`` each of its rows meets.

    Only repeated book numbers matter, and normally there is none: then adaptive execution
    finds the counted side empty and takes the join out as the query runs.
    """
    repeated = (
        books.where(F.col("book_id").isNotNull())
        .groupBy("book_id").agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
    )
    met = spread_join(fact, repeated, "book_id", "left", ["rent_id"], hot._replace(nulls=True))
    return met.withColumn("_n", F.coalesce("_n", F.lit(1).cast("long")))


def dmart_user_book(inputs: Inputs, calendar: bool = False, hot: Hot = Hot()) -> DataFrame:
    """Books and mean rental days per user and day.

    The fact is summed per user and day before it meets the users, so a user
    with very many rentals arrives there with one row per day. ``hot`` names
    books with very many rentals, for the case of many repeated book numbers.
    """
    fact = inputs["fact_rents"].select(
        "rent_id", "user_id", "user_name", "book_id", day_of("created_at").alias("created_at_date"),
        rental_days("created_at", "return_date", calendar).alias("_days"),
    )
    per_day = (
        _copies(fact, inputs["dim_books"], hot)
        .groupBy("user_id", "user_name", "created_at_date")
        .agg(
            F.sum(F.when(F.col("book_id").isNotNull(), F.col("_n"))).alias("_books"),
            F.sum(F.col("_days") * F.col("_n")).alias("_days"),
            F.sum(F.when(F.col("_days").isNotNull(), F.col("_n"))).alias("_returned"),
        )
    )
    users = inputs["dim_users"].groupBy("user_id", "email", "gender").agg(
        F.count(F.lit(1)).alias("_users")
    )
    mean = F.ceil(F.col("_days") / F.col("_returned")).cast("double")
    return per_day.join(users, "user_id", "left").select(
        "user_id", "user_name", "email", "gender",
        (_or_zero(F.col("_books")) * F.coalesce("_users", F.lit(1).cast("long")))
        .alias("sum_of_book"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_rent_duration"),
        "created_at_date",
    )


def _rentals_by_gender(inputs: Inputs, by: list[str], hot: Hot) -> DataFrame:
    """Rentals per gender, book type, genre and ``by``.

    Only the join with the users sees single rentals. Its result is combined per
    gender and book, so a book with very many rentals meets the books as a few
    rows. Rentals without a user are always spread.
    """
    fact = inputs["fact_rents"].select(
        "rent_id", "user_id", "book_id", day_of("created_at").alias("created_at_date")
    )
    users = inputs["dim_users"].select("user_id", "gender")
    per_book = (
        spread_join(fact, users, "user_id", "left", ["rent_id"], hot._replace(nulls=True))
        .groupBy("gender", "book_id", *by)
        .agg(F.count("book_id").alias("_n"))
    )
    books = inputs["dim_books"].select("book_id", "book_type", "genre")
    return (
        per_book.join(books, "book_id", "left")
        .groupBy("gender", "book_type", "genre", *by)
        .agg(F.sum("_n").alias("total_rentals"))
    )


def dmart_gender_book(inputs: Inputs, hot: Hot = Hot()) -> DataFrame:
    """Rentals per gender, book type, genre and day."""
    return _rentals_by_gender(inputs, ["created_at_date"], hot).select(
        "gender", "book_type", "genre", "total_rentals", "created_at_date"
    )


def gender_shares(counts: DataFrame) -> DataFrame:
    """Share of each gender in the rentals of a book type and genre, in percent.

    ``counts`` holds gender, book_type, genre and total_rentals. Groups without a
    type or genre are left out. The total is a window sum over the handful of
    genders of a group, so the rentals are counted once.
    """
    group = Window.partitionBy("book_type", "genre")
    total = F.sum("total_rentals").over(group)
    share = F.col("total_rentals_gender").cast("double") * 100.0 / F.nullif(
        F.col("total_rentals_all"), F.lit(0)
    ).cast("double")
    return (
        counts.where(F.col("book_type").isNotNull() & F.col("genre").isNotNull())
        .select(
            "book_type", "genre", "gender",
            F.col("total_rentals").alias("total_rentals_gender"),
            total.alias("total_rentals_all"),
        )
        .withColumn("percentage_per_gender", F.round(share, 2))
    )


def dmart_book_gender(inputs: Inputs, hot: Hot = Hot()) -> DataFrame:
    """Shares per gender over all days."""
    return gender_shares(_rentals_by_gender(inputs, [], hot))


def book_gender_from_days(gender_book: DataFrame) -> DataFrame:
    """The same from the stored counts per day, without touching the fact again."""
    keys = ["gender", "book_type", "genre"]
    return gender_shares(
        gender_book.groupBy(*keys).agg(F.sum("total_rentals").alias("total_rentals"))
    )


def stock_per_type(inputs: Inputs) -> DataFrame:
    return inputs["dim_books"].groupBy("book_type").agg(
        F.sum("stock").alias("stock_book_per_type")
    )


def dmart_booktype_stock(inputs: Inputs) -> DataFrame:
    """Rentals per book type, by genre and in total, and the stock that is left.

    Rentals are counted per book ahead of the join. Genres beyond the six count
    in the total only; the remaining stock may be negative.
    """
    per_book = inputs["fact_rents"].groupBy("book_id").agg(F.count("book_id").alias("_n"))
    books = inputs["dim_books"].select("book_id", "book_type", "genre")
    per_type = (
        per_book.join(books, "book_id", "left")
        .groupBy("book_type")
        .agg(
            *[
                _or_zero(F.sum(F.when(F.col("genre") == genre, F.col("_n")))).alias(genre)
                for genre in STOCK_GENRES
            ],
            _or_zero(F.sum("_n")).alias("total_rent_per_type"),
        )
    )
    return _with_stock(per_type, inputs)


def _with_stock(per_type: DataFrame, inputs: Inputs) -> DataFrame:
    return per_type.join(stock_per_type(inputs), "book_type", "left").withColumn(
        "sisa_stock",
        _or_zero(F.col("stock_book_per_type")) - F.col("total_rent_per_type"),
    )


def booktype_stock_from_days(gender_book: DataFrame, dim_books: DataFrame) -> DataFrame:
    """The same from the stored counts per day, without touching the fact again."""
    per_type = gender_book.groupBy("book_type").agg(
        *[
            _or_zero(F.sum(F.when(F.col("genre") == genre, F.col("total_rentals")))).alias(genre)
            for genre in STOCK_GENRES
        ],
        _or_zero(F.sum("total_rentals")).alias("total_rent_per_type"),
    )
    return _with_stock(per_type, {"dim_books": dim_books})


# The order each mart is shown in. Stored tables have none.
SHOWN_BY = {
    "dmart_user_book": {"sum_of_book": False},
    "dmart_gender_book": {"gender": True, "total_rentals": False},
    "dmart_book_gender": {"book_type": True, "genre": True, "total_rentals_gender": False},
    "dmart_booktype_stock": {"book_type": True},
}


def shown(name: str, mart: DataFrame) -> DataFrame:
    """A mart in its presentation order."""
    order = SHOWN_BY[name]
    return mart.orderBy(*order, ascending=list(order.values()))
