"""Every rental query against its SQL counterpart, on whole tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def test_every_query_has_sql():
    assert driver._rental_queries().keys() == driver._rental_sql().keys()


@pytest.mark.parametrize("name", sorted(driver._rental_queries()))
def test_query_equals_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    columns = sorted(df.columns)
    result = duck.execute(driver.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = Counter(tuple(_plain(r[i]) for i in places) for r in result.fetchall())
    got = Counter(
        tuple(map(_plain, r)) for r in df.select([f"`{c}`" for c in columns]).collect()
    )
    assert got == expected
    assert got


def test_entry(spark):
    assert not driver.entry(spark).isEmpty()
