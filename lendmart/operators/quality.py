"""Table profiles and constraint reports. Each check combines before it shuffles."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import CONSTRAINTS


def table_profile(df: DataFrame, table: str | None = None) -> DataFrame:
    """One row per column: type, rows, non-NULL values. One scan, one-row aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(df.columns)],
    )
    facts = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(dtype).alias("data_type"),
            F.col("_rows").alias("row_count"),
            F.col(f"_n{i}").alias("non_null_count"),
        )
        for i, (name, dtype) in enumerate(df.dtypes)
    ]
    profile = counts.select(F.inline(F.array(*facts)))
    return profile if table is None else profile.select(F.lit(table).alias("table_name"), "*")


def table_head(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows, for a look at a batch."""
    return df.limit(n)


def constraint_report(tables: dict[str, DataFrame], constraints=CONSTRAINTS) -> DataFrame:
    """(table_name, column_name, rule, violations) for every declared rule.

    ``unique`` and ``primary_key`` count the rows beyond the first of each value. Each table
    is read once: a row gives a (rule, hash) pair for every unique value it holds and every
    rule it breaks, the pairs of all tables are counted together per task and in one
    shuffle, and what is left is a row a rule (so broadcast). The hash has 96 bits.
    """
    rules: list[tuple[str, str, str]] = []
    pairs = []
    for name, df in tables.items():
        declared = constraints[name]
        known = []
        for column, rule, pair in _checks(declared):
            known.append(pair(len(rules)))
            rules.append((name, column, rule))
        present = F.filter(F.array(*known), lambda p: p.isNotNull())
        pairs.append(df.select(F.inline(present)))
    counted = reduce(DataFrame.unionAll, pairs).groupBy("rule", "high", "low", "unique").agg(F.count(F.lit(1)).alias("n"))
    broken = counted.groupBy("rule").agg(F.sum(F.col("n") - F.col("unique").cast("int")).alias("violations"))
    listed = F.array(*[
        F.struct(F.lit(k).alias("rule"), *[F.lit(v).alias(c) for c, v in zip(("table_name", "column_name", "name"), rule)])
        for k, rule in enumerate(rules)
    ])
    every = pairs[0].sparkSession.range(1).select(F.inline(listed))
    return every.join(F.broadcast(broken), "rule", "left").select(
        "table_name", "column_name", F.col("name").alias("rule"),
        F.coalesce("violations", F.lit(0).cast("long")).alias("violations"),
    )


def _checks(rules: dict) -> list[tuple[str, str, Callable[[int], Column]]]:
    """(column, rule, pair) of the rules of a table; ``pair`` gives the (rule, hash) that a
    row adds to the count of the rule with a given number, or NULL."""

    def breaks(bad: Column) -> Callable[[int], Column]:
        return lambda k: F.when(bad, _pair(k, F.lit(0).cast("long"), F.lit(0), False))

    def repeats(column: str) -> Callable[[int], Column]:
        return lambda k: F.when(F.col(column).isNotNull(), _pair(k, F.xxhash64(column), F.hash(column), True))

    return [
        *[(c, "not_null", breaks(F.col(c).isNull())) for c in (rules["key"], *rules["required"])],
        *[(c, f"max_length_{limit}", breaks(F.length(c) > limit)) for c, limit in rules["max_length"].items()],
        (rules["key"], "primary_key", repeats(rules["key"])),
        *[(c, "unique", repeats(c)) for c in rules["unique"]],
    ]


def _pair(number: int, high: Column, low: Column, unique: bool) -> Column:
    return F.struct(
        F.lit(number).alias("rule"), high.alias("high"), low.alias("low"), F.lit(unique).alias("unique")
    )


def fk_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """(column_name, key_value, orphan_rows) for key values the parent lacks.

    The child is counted per key first, so a key with very many rows meets the
    parent as one row. NULL keys break no foreign key.
    """
    used = child.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("orphan_rows")
    )
    return used.join(parent.select(key).distinct(), key, "left_anti").select(
        F.lit(key).alias("column_name"), F.col(key).alias("key_value"), "orphan_rows"
    )
