from __future__ import annotations

import os
import sys
import uuid
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lendmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "local[8]", "lendmart-tests",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(root / "warehouse"),
        spark__checkpoint__dir=str(root / "shared"),
        # Without checksum files a table of many small days is written twice as fast.
        spark__hadoop__fs__file__impl="org.apache.hadoop.fs.RawLocalFileSystem",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layers():
    """A namespace of its own for each test."""
    tag = uuid.uuid4().hex[:8]
    return {layer: f"{layer}_{tag}" for layer in ("warehouse", "preparation", "dimfact", "datamart")}


@pytest.fixture
def database(spark):
    name = "db_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {name}")
    return name


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *order):
    """All rows as tuples, sorted with NULLs first."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, v) for v in r))
