"""Digests per day that do not depend on the order of rows.

A day's digest is its number of rows and two sums of a hash of every row, by exclusive or
and by addition. Digests of parts add up to the digest of the whole, so an appended batch is
absorbed without reading the table again, and two tables are compared by one row a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Columns of a digest table.
DIGEST = ("day", "rows", "mixed", "total")


def row_hash(columns: list[str]) -> Column:
    """A 64-bit hash of a row. The flags tell NULLs apart, which the hash alone skips."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`").isNull() for c in columns])


def day_digests(df: DataFrame, columns: list[str], ts: str = "created_at") -> DataFrame:
    """(day, rows, mixed, total) for every day of ``ts`` and for rows without one.

    Combined per task before the shuffle, so a day's rows never meet.
    """
    hashed = df.select(F.to_date(ts).alias("day"), row_hash(columns).alias("_hash"))
    return hashed.groupBy("day").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("_hash").alias("mixed"),
        F.sum(F.col("_hash").cast("decimal(38,0)")).alias("total"),
    )


def combined_digests(one: DataFrame, other: DataFrame) -> DataFrame:
    """The digests of the rows of both."""
    return one.select(*DIGEST).unionAll(other.select(*DIGEST)).groupBy("day").agg(
        F.sum("rows").alias("rows"), F.bit_xor("mixed").alias("mixed"),
        F.sum("total").cast("decimal(38,0)").alias("total"),
    )


def differing_days(source: DataFrame, target: DataFrame) -> DataFrame:
    """(day, source_rows, target_rows) of the days whose digests differ; a day that one side
    lacks has 0 rows there."""
    both = source.alias("s").join(target.alias("t"), F.col("s.day").eqNullSafe(F.col("t.day")), "full")
    same = F.lit(True)
    for name in DIGEST[1:]:
        same = same & F.col(f"s.{name}").eqNullSafe(F.col(f"t.{name}"))
    zero = F.lit(0).cast("long")
    return both.where(~same).select(
        F.coalesce("s.day", "t.day").alias("day"),
        F.coalesce("s.rows", zero).alias("source_rows"), F.coalesce("t.rows", zero).alias("target_rows"),
    )
