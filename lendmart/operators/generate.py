"""Bulk test data in the shape of the operational tables.

Every value is a hash of (row number, seed), so the same call gives the same
rows on any cluster and after any task is run again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..schemas import BOOK_TYPES, GENDERS, GENRES

_FIRST = ("Ada", "Budi", "Citra", "Dewi", "Eka", "Farid", "Gita", "Hana", "Indra", "Joko",
          "Kirana", "Lina", "Maya", "Nanda", "Okta", "Putri", "Rina", "Sari", "Tono", "Wulan")
_LAST = ("Halim", "Hartono", "Irawan", "Kusuma", "Lestari", "Mahendra", "Nugroho", "Pratama",
         "Rahayu", "Santoso", "Setiawan", "Suryadi", "Utami", "Wibowo", "Wijaya", "Yulianto")
_WORDS = ("amber", "bridge", "cloud", "distant", "early", "forest", "golden", "harbor", "island",
          "journey", "lantern", "morning", "northern", "ocean", "paper", "river", "silent",
          "summer", "tower", "winter")
_STREETS = ("Jalan Melati", "Jalan Mawar", "Jalan Kenanga", "Jalan Anggrek", "Jalan Cempaka")

# Rows per bucket of the random lookup; a bucket is one small window group.
_BUCKET = 64


def _draw(seed: int, what: str, n: int | Column) -> Column:
    """A number in [0, n), fixed by the row's ``id``, the seed and the purpose."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(what)), n)


def _pick(seed: int, what: str, values: tuple) -> Column:
    position = _draw(seed, what, len(values)).cast("int") + 1
    return F.element_at(F.array(*map(F.lit, values)), position)


def _time(now: datetime | str) -> Column:
    return F.to_timestamp_ntz(F.lit(str(now)))


def _full_name(seed: int, what: str) -> Column:
    return F.concat_ws(" ", _pick(seed, what + " first", _FIRST), _pick(seed, what + " last", _LAST))


def synth_users(spark: SparkSession, n: int, seed: int, now: datetime | str,
                start: int = 1) -> DataFrame:
    """``n`` users. Emails follow from the names, so they may repeat (see ``insert_ignore``)."""
    return spark.range(start, start + n).withColumn("name", _full_name(seed, "user")).select(
        F.col("id").alias("user_id"),
        "name",
        F.concat(F.lower(F.replace("name", F.lit(" "), F.lit("."))), F.lit("@example.com"))
        .alias("email"),
        F.concat(_pick(seed, "street", _STREETS), F.lit(" "),
                 (_draw(seed, "number", 200) + 1).cast("string")).alias("address"),
        _pick(seed, "gender", GENDERS).alias("gender"),
        _time(now).alias("created_at"),
    )


def synth_books(spark: SparkSession, n: int, seed: int, now: datetime | str,
                start: int = 1) -> DataFrame:
    """``n`` books from 2000 to 2023 with 1 to 10 copies each."""
    title = F.concat_ws(" ", *[_pick(seed, f"word {i}", _WORDS) for i in range(3)])
    return spark.range(start, start + n).select(
        F.col("id").alias("book_id"),
        F.concat(F.initcap(title), F.lit(".")).alias("title"),
        _full_name(seed, "author").alias("author"),
        _pick(seed, "type", BOOK_TYPES).alias("book_type"),
        _pick(seed, "genre", GENRES).alias("genre"),
        F.concat(_pick(seed, "publisher", _LAST), F.lit(" Press")).alias("publisher"),
        (_draw(seed, "year", 24) + 2000).alias("release_year"),
        (_draw(seed, "stock", 10) + 1).alias("stock"),
        _time(now).alias("created_at"),
    )


def synth_rents(users: DataFrame, books: DataFrame, n: int, seed: int, now: datetime | str,
                start: int = 1) -> DataFrame:
    """``n`` rentals of a random user and a random book in stock.

    Rented 3 to 7 days before ``now`` and returned 1 to 3 days later. Without
    users or without books in stock there are no rentals.
    """
    spark = users.sparkSession
    rents = spark.range(start, start + n)
    rents = _assign(rents, users.select("user_id"), "user_id", seed)
    rents = _assign(rents, books.where(F.col("stock") > 0).select("book_id"), "book_id", seed)
    day = F.make_dt_interval((_draw(seed, "rented", 5) + 3).cast("int"))
    back = F.make_dt_interval((_draw(seed, "returned", 3) + 1).cast("int"))
    rented = _time(now) - day
    return rents.select(
        F.col("id").alias("rent_id"), "user_id", "book_id",
        rented.alias("rent_date"), (rented + back).alias("return_date"),
        _time(now).alias("created_at"),
    )


def _assign(rents: DataFrame, pool: DataFrame, key: str, seed: int) -> DataFrame:
    """Gives each row a random member of ``pool``.

    The pool is numbered inside small hash buckets rather than as a whole, so no
    task sorts all of it. A row draws a bucket, then a place in it.
    """
    buckets = max(1, pool.count() // _BUCKET)
    member = pool.withColumn("_bucket", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets)))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    member = member.withColumn("_place", place.cast("long"))
    sizes = member.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    drawn = rents.withColumn("_bucket", _draw(seed, key + " bucket", buckets))
    drawn = drawn.join(sizes, "_bucket").withColumn(
        "_place", _draw(seed, key + " place", F.col("_size"))
    )
    return drawn.join(member, ["_bucket", "_place"]).drop("_bucket", "_place", "_size")
