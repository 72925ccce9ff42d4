"""Dimensions and the rental fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import Hot, spread_join
from .preparation import Inputs


def dim_users(inputs: Inputs) -> DataFrame:
    return inputs["prep_users"]


def dim_books(inputs: Inputs) -> DataFrame:
    return inputs["prep_books"]


FACT_COLUMNS = (
    "rent_id", "rent_date", "return_date", "user_id", "user_name", "email", "gender",
    "book_id", "title", "author", "book_type", "genre", "release_year", "created_at",
)


def fact_rents(inputs: Inputs, hot: dict[str, Hot] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rentals with what the dimensions know about their user and book.

    Both numbers come from the dimensions, so a rental without a matching user
    or book shows NULL there. ``hot`` (see ``hot_keys``) names users and books
    with very many rentals; their rows are spread over many tasks. ``keep`` names further
    columns of the rentals to go on with.
    """
    hot = hot or {}
    rents = inputs["prep_rents"].select(
        "rent_id", "rent_date", "return_date",
        F.col("user_id").alias("_user"), F.col("book_id").alias("_book"), "created_at", *keep,
    )
    users = inputs["dim_users"].select(
        F.col("user_id").alias("_user"), "user_id", F.col("name").alias("user_name"),
        "email", "gender",
    )
    books = inputs["dim_books"].select(
        F.col("book_id").alias("_book"), "book_id", "title", "author", "book_type", "genre",
        "release_year",
    )
    joined = spread_join(rents, users, "_user", "left", ["rent_id"], hot.get("user_id", Hot()))
    joined = spread_join(joined, books, "_book", "left", ["rent_id"], hot.get("book_id", Hot()))
    return joined.select(*FACT_COLUMNS, *keep)
