"""Slices, time texts, CSV and staging."""

from __future__ import annotations

import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F, types as T

from conftest import at, rows
from lendmart.schemas import RENTS, USERS, layer_name
from lendmart.sources import landing, readers
from lendmart.sources.readers import read_source, split_points, split_predicates, split_query
from lendmart.operators.quality import table_head, table_profile

ITEM = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])


def items(spark, *values):
    return spark.createDataFrame([(i, n, at(t) if t else None) for i, n, t in values], ITEM)


def test_slice_leaves_the_last_second_out(spark):
    df = items(
        spark, (1, "a", "2025-01-01 23:59:58.900000"), (2, "b", "2025-01-01 23:59:59"),
        (3, "c", "2025-01-01 23:59:59.500000"), (4, "d", "2025-01-02 00:00:00"), (5, "e", None),
    )
    assert [r.id for r in readers.daily_slice(df, "2025-01-01").collect()] == [1]
    exact = readers.daily_slice(df, "2025-01-01", exact=True)
    assert sorted(r.id for r in exact.collect()) == [1, 2, 3]


def test_empty_slice(spark):
    df = items(spark, (1, "a", "2025-01-01 10:00:00"))
    assert readers.daily_slice(df, "2025-02-01").isEmpty()
    with pytest.raises(readers.EmptySlice):
        readers.daily_slice(df, "2025-02-01", on_empty="error")


def test_slice_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "items.parquet")
    items(spark, (1, "a", "2025-01-01 10:00:00")).write.parquet(path)
    df = readers.read_source(spark, "items", path=str(tmp_path), day="2025-01-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(created_at), GreaterThanOrEqual(created_at" in plan
    assert df.count() == 1


def test_slice_day_is_yesterday_in_jakarta():
    late = datetime(2025, 1, 1, 18, 0, tzinfo=timezone.utc)  # already the 2nd in Jakarta
    assert readers.slice_day(late) == date(2025, 1, 1)
    assert readers.slice_day(late, "UTC") == date(2024, 12, 31)


def test_jdbc_ranges_cover_the_slice_once():
    parts = readers.slice_predicates("2025-01-01", 3)
    bounds = [p.replace("created_at ", "").split(" AND ") for p in parts]
    assert bounds[0][0] == ">= '2025-01-01 00:00:00'"
    assert bounds[-1][1] == "< '2025-01-01 23:59:59'"
    for (_, high), (low, _) in zip(bounds, bounds[1:]):
        assert high[2:] == low[3:]


def test_jdbc_reader_options(monkeypatch, spark):
    seen = {}

    class Reader:
        def options(self, **opts):
            seen["options"] = opts
            return self

        def jdbc(self, url, table, predicates=None):
            seen.update(url=url, table=table, predicates=predicates)

    class Session:
        read = Reader()

    readers.read_source(Session(), "rents_data", "jdbc", url="jdbc:x", namespace="shop",
                        day="2025-01-01", parts=4, user="u")
    assert seen["table"] == "shop.rents" and len(seen["predicates"]) == 4
    assert seen["options"] == {"preferTimestampNTZ": "true", "fetchsize": "10000", "user": "u"}


def test_normalize_cuts_subseconds(spark):
    df = spark.createDataFrame(
        [(1735689599999, at("2024-12-31 23:59:59.999999")), (-1, None), (None, None)],
        "rent_date long, created_at timestamp_ntz",
    )
    assert [tuple(r) for r in readers.normalize_ts(df).collect()] == [
        ("2024-12-31 23:59:59", "2024-12-31 23:59:59"), ("1969-12-31 23:59:59", None),
        (None, None),
    ]


def test_normalize_ignores_the_session_zone(spark):
    df = spark.createDataFrame([(1735689599999,)], "created_at long")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        assert readers.normalize_ts(df).first()[0] == "2024-12-31 23:59:59"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _csv(tmp_path, *lines):
    folder = tmp_path / "batch"
    folder.mkdir()
    (folder / "part.csv").write_text("\n".join(["id,name,created_at", *lines]) + "\n")
    return str(folder)


def test_staging_verdicts(spark, tmp_path, database):
    path = _csv(
        tmp_path,
        "1,good,2025-01-01 00:00:00",
        "x,bad id,2025-01-01 00:00:00",
        "3,extra,2025-01-01 00:00:00,more",
        "4,too few",
        '5,"a ""quoted"", name",2025-01-01 00:00:00',
        "6,bad time,soon",
        "7,no time,",
        '8,"extra, quoted",,"x,y"',
        "9.5,fraction,2025-01-01 00:00:00",
    )
    loaded = landing.load_staging(spark, path, ITEM, f"{database}.staging")
    assert rows(loaded) == [
        (1, "good", at("2025-01-01 00:00:00")),
        (3, "extra", at("2025-01-01 00:00:00")),
        (5, 'a "quoted", name', at("2025-01-01 00:00:00")),
        (7, "no time", None),
        (8, "extra, quoted", None),
    ]


def test_bad_row_budget(spark, tmp_path, database):
    table = f"{database}.staging"
    good = _csv(tmp_path, "1,a,2025-01-01 00:00:00", *[f"x{i},b,"for i in range(100)])
    assert landing.load_staging(spark, good, ITEM, table).count() == 1
    (tmp_path / "more").mkdir()
    worse = _csv(tmp_path / "more", "2,a,2025-01-01 00:00:00", *[f"x{i},b," for i in range(101)])
    with pytest.raises(landing.TooManyBadRows, match="101"):
        landing.load_staging(spark, worse, ITEM, table)
    assert [r.id for r in spark.table(table).collect()] == [1]  # the old content stands


def test_missing_file(spark, tmp_path, database):
    with pytest.raises(FileNotFoundError):
        landing.load_staging(spark, str(tmp_path / "none"), ITEM, f"{database}.staging")


def test_csv_round_trip(spark, tmp_path, database):
    df = items(spark, (1, ' spaced, "quoted" ', "2025-01-01 00:00:00"), (2, None, None),
               (3, "back\\slash", "2025-01-01 10:00:00"))
    landing.write_csv(readers.normalize_ts(df), str(tmp_path / "out"))
    back = landing.load_staging(spark, str(tmp_path / "out"), ITEM, f"{database}.staging")
    assert rows(back) == rows(df)


def test_staging_is_replaced(spark, tmp_path, database):
    for i in (1, 2):
        (tmp_path / str(i)).mkdir()
        path = _csv(tmp_path / str(i), f"{i},n,2025-01-0{i} 00:00:00")
        landing.load_staging(spark, path, ITEM, f"{database}.staging")
    assert [r.id for r in spark.table(f"{database}.staging").collect()] == [2]


def test_tables_are_stored_by_day(spark, database):
    table = f"{database}.items"
    landing.write_partitioned(
        items(spark, (1, "a", "2025-01-01 10:00:00"), (2, "b", "2025-01-02 10:00:00"),
              (3, "c", None)), table)
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 3
    assert landing.stored_watermark(spark, table) == at("2025-01-02 10:00:00")
    assert landing.stored(spark, table).columns == ["id", "name", "created_at"]
    # Rebuilt from itself.
    landing.write_partitioned(landing.stored(spark, table).where("id > 1"), table)
    assert sorted(r.id for r in spark.table(table).collect()) == [2, 3]


def test_watermark_reads_one_day(spark, database):
    table = f"{database}.items"
    landing.ensure_table(spark, table, ITEM)
    landing.ensure_table(spark, table, ITEM)
    assert landing.stored_watermark(spark, table) is None
    assert spark.table(table).columns == ["id", "name", "created_at", "created_date"]


def test_metrics_are_appended_whole_or_not_at_all(spark, database):
    table = f"{database}.metrics"
    schema = "`Jumlah Akumulasi - orang` long, created_at timestamp_ntz"
    good = spark.createDataFrame([(1, at("2025-01-01 03:00:00"))], schema)
    holed = spark.createDataFrame([(2, at("2025-01-02 03:00:00")), (None, None)], schema)
    assert landing.append_metrics(None, table) is False
    assert landing.append_metrics(good.limit(0), table) is False
    assert landing.append_metrics(good, table) is True
    assert landing.append_metrics(holed, table) is False
    assert landing.append_metrics(good, table) is True
    assert [r[0] for r in spark.table(table).collect()] == [1, 1]


def test_profile_and_head(spark):
    df = items(spark, (1, None, "2025-01-01 10:00:00"), (2, "b", None))
    assert [tuple(r) for r in table_profile(df, "items").collect()] == [
        ("items", 0, "id", "bigint", 2, 2), ("items", 1, "name", "string", 2, 1),
        ("items", 2, "created_at", "timestamp_ntz", 2, 1),
    ]
    assert table_head(df, 1).count() == 1


def test_layer_names():
    assert layer_name("x", {"x": " custom "}) == "custom"
    assert layer_name("x", {"x": None}, "fallback") == "fallback"


def test_schemas_hold_the_keys():
    assert USERS.names[0] == "user_id" and RENTS.names[0] == "rent_id"


def test_one_hostile_row_costs_one_bad_row(spark, tmp_path, database):
    """Very many quotes in one row, with a value too many or too few."""
    quoted = '"' + '""' * 100_000 + '"'
    path = _csv(tmp_path, "1,a,2025-01-01 00:00:00", f"2,{quoted},2025-01-01 00:00:00,more", f"3,{quoted}")
    table = f"{database}.staging"
    staged = landing.load_staging(spark, path, ITEM, table, max_bad=1)
    assert sorted(r.id for r in staged.collect()) == [1, 2]
    refused = spark.table(f"{table}__rejected").collect()
    assert [r.reason for r in refused] == ["too few values"] and refused[0].line.startswith("3,")


def test_epochs_of_every_numeric_type(spark):
    for kind in ("bigint", "double", "decimal(18,3)"):
        df = spark.sql(f"SELECT CAST(1736467200789 AS {kind}) AS created_at")
        assert readers.normalize_ts(df).first()[0] == "2025-01-10 00:00:00"
    with pytest.raises(TypeError):
        readers.normalize_ts(spark.sql("SELECT true AS created_at"))


# --- splitting whole tables ---------------------------------------------------------------
def _dealt(rows_, keys, points):
    """How many conditions each row meets, by the rules of a database."""
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    con.register("t", pd.DataFrame(rows_))
    parts = split_predicates(keys, points)
    tests = ", ".join(f"count(*) FILTER ({p}) AS p{k}" for k, p in enumerate(parts))
    met = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in parts)
    sizes = con.execute(f"SELECT {tests} FROM t").fetchone()
    return sizes, {r[0] for r in con.execute(f"SELECT DISTINCT {met} FROM t").fetchall()}


@pytest.mark.parametrize("parts", [1, 2, 7, 50])
def test_split_covers_every_row_once_and_evenly(parts):
    """Gaps in the keys, a value that a third of the rows share, NULL keys, quotes."""
    import duckdb
    import pandas as pd

    table = pd.DataFrame({
        "a": [None if k % 11 == 0 else 7 if k % 3 == 0 else k * k for k in range(900)],
        "b": [f"o'{k % 13}" for k in range(900)], "c": range(900),
    })
    con = duckdb.connect()
    con.register("t", table)
    for keys, worst in ((["c"], 1), (["a", "c"], 1), (["b", "a", "c"], 1), (["a"], 400), (["b"], 70)):
        found = con.execute(split_query("t", keys, parts)).fetchall()
        assert len(found) <= parts - 1
        points = [row[:-1] for row in sorted(found, key=lambda row: row[-1])]
        sizes, met = _dealt(table, keys, points)
        assert met == {1}
        assert sizes[-1] == table[keys].isna().any(axis=1).sum()
        filled = table[keys].notna().all(axis=1).sum()
        assert sum(sizes[:-1]) == filled and max(sizes[:-1]) <= max(-(-filled // parts), worst) + (worst > 1) * filled // parts


def test_split_of_an_empty_table_and_odd_points():
    assert split_predicates(["k"], []) == ["k IS NOT NULL", "k IS NULL"]
    parts = split_predicates(["k"], [(3,), (3,), (5,)])
    assert len(parts) == 4 and parts[0] == "k IS NOT NULL AND ((k < 3))"
    with pytest.raises(TypeError):
        split_predicates(["k"], [(None,)])
    assert split_predicates(["d"], [(date(2025, 1, 2),), (datetime(2025, 1, 3, 4, 5),)])[1].count("'2025-01-0") == 2


def test_split_points_of_a_table_spark_reads(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id % 9 = 0 THEN NULL WHEN id % 2 = 0 THEN 5 ELSE id END AS k", "id")
    points = split_points(df, "k", 8)
    assert len(points) == 7 and split_points(df, "k", 1) == []
    met = df.select(sum(F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in split_predicates(["k"], points)).alias("n"))
    assert {r.n for r in met.distinct().collect()} == {1}
    assert split_points(df.where("k IS NULL"), "k", 4) == []


def test_whole_jdbc_tables_are_read_by_ranges(spark, monkeypatch):
    """What reaches the JDBC reader; no database is needed for that."""
    from pyspark.sql import DataFrameReader

    calls = []

    def jdbc(self, url, table, predicates=None, **_):
        calls.append((table, predicates))
        return spark.createDataFrame([(5, 9, 3), (2, 1, 2)], "a long, b long, place_ long")

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    read_source(spark, "rents_data", "jdbc", url="jdbc:x", namespace="lib", split_by=["a", "b"], parts=3)
    (points, none), (table, predicates) = calls
    assert none is None and "lib.rents" in points and "ROW_NUMBER() OVER (ORDER BY a, b)" in points
    assert table == "lib.rents" and len(predicates) == 4
    assert predicates[1].endswith("NOT ((a < 2) OR (a = 2 AND b < 1)) AND ((a < 5) OR (a = 5 AND b < 9))")


# --- replacing tables under readers ---------------------------------------------------------
def test_readers_never_miss_a_table_that_is_replaced(spark, database):
    import threading

    table = f"{database}.small"
    landing.write_partitioned(spark.range(5).withColumn("v", F.lit(0)), table, None)
    wrong, seen, done = [], set(), threading.Event()

    def read():
        while not done.is_set():
            try:
                found = {tuple(r) for r in spark.table(table).groupBy("v").count().collect()}
                seen.update(v for v, _ in found)
                if len(found) != 1 or {n for _, n in found} != {5}:
                    wrong.append(found)
            except Exception as error:  # noqa: BLE001
                wrong.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for version in range(1, 6):
        landing.write_partitioned(spark.range(5).withColumn("v", F.lit(version)), table, None)
    done.set()
    reader.join()
    assert not wrong and len(seen) > 1
    # its own content may be read while it is replaced
    landing.write_partitioned(spark.table(table).where("id > 2"), table, None)
    assert spark.table(table).count() == 2
    folder = spark.sql(f"DESCRIBE DATABASE {database}").where("info_name = 'Location'").first()[1].removeprefix("file:")
    assert len([d for d in os.listdir(folder) if d.startswith("small")]) == 2  # the current one and the last
    landing.drop_table(spark, table)
    assert not [d for d in os.listdir(folder) if d.startswith("small")]


def test_writers_side_by_side_keep_their_own_mode(spark, database):
    from concurrent.futures import ThreadPoolExecutor

    table = f"{database}.days"
    first = spark.range(60).selectExpr("id", "TIMESTAMP_NTZ'2025-01-01 10:00:00' + make_dt_interval(cast(id % 6 AS int)) AS created_at")
    landing.write_partitioned(first, table)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")

    def replace(day):
        part = first.where(F.dayofmonth("created_at") == day)
        landing.replace_days(part.withColumn("id", F.col("id") + 100), table, {date(2025, 1, day)})

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(replace, (1, 2, 3)))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    got = rows(landing.stored(spark, table).selectExpr("id"))
    assert got == sorted([(k + 100 if k % 6 < 3 else k,) for k in range(60)])
