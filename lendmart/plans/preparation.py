"""Preparation layer: the columns the warehouse goes on with."""

from __future__ import annotations

from pyspark.sql import DataFrame

Inputs = dict[str, DataFrame]


def prep_users(inputs: Inputs) -> DataFrame:
    return inputs["users"].select("user_id", "name", "email", "gender", "created_at")


def prep_books(inputs: Inputs) -> DataFrame:
    return inputs["books"].select(
        "book_id", "title", "author", "book_type", "genre", "release_year", "stock", "created_at"
    )


def prep_rents(inputs: Inputs) -> DataFrame:
    return inputs["rents"]
