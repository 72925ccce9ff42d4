"""Equi-joins that stay balanced when one key holds a large part of the rows.

A shuffle sends all rows of a key to one task, and NULL keys to one task as
well. ``hot_keys`` finds the few values that matter in one pass with a bounded
sketch; ``spread_join`` gives rows of those keys a salt and repeats the matching
right-hand rows once per salt. Which keys are salted never changes the result.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

# Pieces a hot key is cut into, per shuffle partition. Several small pieces per
# partition even out better than one.
PIECES = 4
# A key is hot from this part of all rows on; fewer than 1/SHARE keys can be.
SHARE = 0.01
# Entries of the sketch; its error is a few rows in this many.
_TRACKED = 4096


class Hot(NamedTuple):
    """Hot values of one key. ``nulls``: NULL keys are frequent too."""

    values: tuple = ()
    nulls: bool = False

    def __bool__(self) -> bool:
        return bool(self.values) or self.nulls


NULLS_ONLY = Hot(nulls=True)


def hot_keys(df: DataFrame, *columns: str, share: float = SHARE) -> dict[str, Hot]:
    """Frequent values per column, from one aggregation that returns one row.

    ``approx_top_k`` keeps a fixed-size sketch per task, so nothing but sketches
    is shuffled and at most ``1/share`` values per column come back.
    """
    top = int(1 / share)
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.expr(f"approx_top_k(`{c}`, {top}, {_TRACKED})").alias(f"top_{c}") for c in columns],
    ).first()
    floor = row["rows"] * share
    return {
        c: Hot(
            values=tuple(
                t["item"] for t in row[f"top_{c}"] or ()
                if t["item"] is not None and t["count"] > floor
            ),
            nulls=row["rows"] - row[f"n_{c}"] > floor,
        )
        for c in columns
    }


def spread_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str,
                spread_by: Iterable[str], hot: Hot = Hot(), salts: int | None = None) -> DataFrame:
    """``left.join(right, on, how)`` for how in left, left_semi, left_anti, inner.

    ``spread_by`` are left columns that differ between rows of one key. The salt
    is their hash, not a random number: a task that is run again after a lost
    executor must produce the same rows. Without hot keys this is a plain join,
    left to adaptive execution. With a composite key, ``hot.values`` are hashes
    ``xxhash64(*on)``. At most ``1/SHARE`` keys are hot, so the repeated right-hand
    rows stay few: normally one per hot key and salt.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if not hot:
        return left.join(right, keys, how)
    if salts is None:
        salts = PIECES * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_null = F.lit(False)
    for key in keys:
        is_null = is_null | F.col(key).isNull()
    is_hot = _identity(keys).isin(*hot.values) if hot.values else F.lit(False)
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    left = left.withColumn("_salt", F.when(is_null | is_hot, salt).otherwise(0))
    right = right.withColumn(
        "_salt",
        F.explode(
            F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        ),
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def _identity(keys: list[str]) -> Column:
    return F.col(keys[0]) if len(keys) == 1 else F.xxhash64(*keys)
