"""Writing: interchange CSV, staging, warehouse tables and the metrics table.

Tables are Parquet tables of the session catalog, one database per layer, stored
by day. Nothing is deleted before its replacement is written, a table is never
missing while it is replaced, and what a write needs is set on that write, not on
the session, so jobs may run side by side.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..operators.joins import Hot
from ..operators.merge import ambiguous, matched, new_rows, upsert

DAY = "created_date"

# Fixed value: rejected rows one load may have.
MAX_BAD = 100

_CSV = {
    "header": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


# --- databases and tables ---------------------------------------------------------
def ensure_layer(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Creates the database of a layer unless it exists."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    return name


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def ensure_table(spark: SparkSession, table: str, schema: T.StructType,
                 ts: str | None = "created_at") -> None:
    """Creates an empty table unless it exists, stored by the day of ``ts``."""
    if not table_exists(spark, table):
        write_partitioned(spark.createDataFrame([], schema), table, ts)


def _by_day(df: DataFrame, ts: str | None, day: str) -> tuple[DataFrame, list[str]]:
    """Adds the storage day and gathers a day's rows in as few files as sensible.

    The rebalance hint lets adaptive execution merge small days and split a day
    that holds very many rows.
    """
    if ts is None:
        return df, []
    if ts != day:
        df = df.drop(day).withColumn(day, F.to_date(ts))
    columns = [c for c in df.columns if c != day] + [day]
    return df.select(columns).hint("rebalance", day), [day]


def _create(df: DataFrame, table: str, by: list[str]) -> None:
    """Creates an empty table with the columns of ``df`` unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    parts = f" PARTITIONED BY ({', '.join(by)})" if by else ""
    df.sparkSession.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{parts}")


def _write(df: DataFrame, table: str, by: list[str], replace: bool) -> set[tuple]:
    """Writes files into the parts of a table that occur in ``df``, beside those there or, at
    commit, in their place; returns the parts. ``df`` may read the table.

    The write mode goes with the write, so a job beside it keeps its own, and the catalog is
    told of new parts in a few statements, without looking through the folders again.
    """
    spark = df.sparkSession
    kept = Observation()
    seen = df.observe(kept, F.collect_set(F.struct(*by)).alias("parts"))
    mode = "overwrite" if replace else "append"
    options = {"partitionOverwriteMode": "dynamic"} if replace else {}
    seen.write.mode(mode).options(**options).partitionBy(*by).parquet(_location(spark, table))
    parts = {tuple(part[c] for c in by) for part in kept.get["parts"]}
    _alter(spark, table, "ADD IF NOT EXISTS", " ", [_spec(zip(by, part)) for part in parts])
    spark.catalog.refreshTable(table)
    return parts


def beside(table: str, purpose: str) -> str:
    """A name of its own for a table that lives as long as one job."""
    return f"{table}__{purpose}_{uuid.uuid4().hex[:12]}"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"]


def _remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _overwrite_days(df: DataFrame, table: str, day: str) -> set:
    """Replaces the days that occur in ``df`` and returns them."""
    return {part[0] for part in _write(df, table, [day], True)}


def write_partitioned(df: DataFrame, table: str, ts: str | None = "created_at",
                      mode: str = "replace", day: str = DAY) -> None:
    """Stores a DataFrame by the day of ``ts`` (``None``: not by day).

    ``append`` adds files. ``replace`` never deletes before the new rows are
    written, so the DataFrame may read the table and a failed job leaves the old
    content: days are overwritten one by one at commit, days without rows are
    dropped after it, and a table not stored by day is written to a new folder
    that the catalog then points to.
    """
    spark = df.sparkSession
    df, by = _by_day(df, ts, day)
    if not table_exists(spark, table):
        if not by:
            df.write.format("parquet").saveAsTable(table)
            return
        _create(df, table, by)
        mode = "append"
    if mode == "append" and by:
        _write(df.select(spark.table(table).columns), table, by, False)
    elif mode == "append":
        df.select(spark.table(table).columns).write.insertInto(table)
    elif by:
        present = _overwrite_days(df.select(spark.table(table).columns), table, day)
        _drop_days(spark, table, day, stored_days(spark, table) - present)
    else:
        _switch(df, table)


def _switch(df: DataFrame, table: str) -> None:
    """Replaces a table not stored by day by pointing it to a new folder.

    Readers see the old or the new content at any time. The folder that was current stays
    until the next replacement, for readers that have planned on it.
    """
    spark = df.sparkSession
    current = _location(spark, table)
    folder = f"{current.rsplit('/', 1)[0]}/{beside(table.rsplit('.', 1)[-1], 'v')}"
    df.select(spark.table(table).columns).write.parquet(folder)
    known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('previous' = '{current}')")
    spark.catalog.refreshTable(table)
    if "previous" in known:
        _remove_folder(spark, known["previous"])


def drop_table(spark: SparkSession, table: str) -> None:
    """Drops a table with the folder it had before its last replacement."""
    if table_exists(spark, table):
        known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        if "previous" in known:
            _remove_folder(spark, known["previous"])


def replace_days(df: DataFrame, table: str, days: Iterable, ts: str = "created_at", day: str = DAY) -> None:
    """Replaces ``days`` of a table by ``df``, which holds rows of these days only; a day
    that has none is dropped."""
    content, _ = _by_day(df, ts, day)
    spark = df.sparkSession
    present = _overwrite_days(content.select(spark.table(table).columns), table, day)
    _drop_days(spark, table, day, set(days) - present)


def put_parts(df: DataFrame, table: str, by: list[str]) -> None:
    """Replaces the parts of a table, told apart by ``by``, that occur in ``df``; creates the
    table if it is missing. Putting the same rows twice leaves them once."""
    _create(df, table, by)
    _write(df.hint("rebalance", *by), table, by, True)


def drop_parts(spark: SparkSession, table: str, gone: Callable[[dict[str, str]], bool]) -> None:
    """Drops the parts of a table whose values, as the catalog has them, ``gone`` picks."""
    found = [dict(v.split("=", 1) for v in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    _alter(spark, table, "DROP IF EXISTS", ", ", [_spec(part.items()) for part in found if gone(part)])


# Parts named in one catalog statement.
_SPECS = 1000


def _spec(values: Iterable[tuple]) -> str:
    def literal(value) -> str:
        if value is None:
            return "NULL"
        return f"DATE'{value}'" if isinstance(value, date) else f"'{value}'"

    return f"PARTITION ({', '.join(f'{c}={literal(v)}' for c, v in values)})"


def _alter(spark: SparkSession, table: str, change: str, between: str, specs: list[str]) -> None:
    for k in range(0, len(specs), _SPECS):
        spark.sql(f"ALTER TABLE {table} {change} {between.join(specs[k : k + _SPECS])}")


def stored_days(spark: SparkSession, table: str) -> set[date | None]:
    """The days a table has a folder for, from the catalog; ``None``: no day."""
    values = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return {date.fromisoformat(v) if v[:1].isdigit() else None for v in values}


def _drop_days(spark: SparkSession, table: str, day: str, days: set) -> None:
    _alter(spark, table, "DROP IF EXISTS", ", ", [_spec([(day, value)]) for value in days])


def stored(spark: SparkSession, table: str, day: str = DAY) -> DataFrame:
    """A table without its derived storage column."""
    df = spark.table(table)
    return df.drop(day) if day == DAY else df


def stored_watermark(spark: SparkSession, table: str, ts: str = "created_at",
                     day: str = DAY) -> datetime | None:
    """Newest ``ts`` of a table stored by day; only its last day is read."""
    days = stored_days(spark, table) - {None}
    if not days:
        return None
    last = spark.table(table).where(F.col(day) == F.lit(max(days)))
    return last.agg(F.max(ts)).first()[0]


# --- CSV and staging -----------------------------------------------------------------
def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV, as many files as the DataFrame has partitions."""
    df.write.mode("overwrite").options(**_CSV).csv(path)


class TooManyBadRows(ValueError):
    """More rejected rows than the budget allows."""


def parse_staging(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV rows cast to ``schema``, with ``_bad`` on those a load rejects, and for these
    the values as read (``_row``) and the ``_reason``.

    All columns are read as text. A row is bad if it has too few values or a
    value that is no number or time where one is due. Extra values are ignored.
    """
    names = schema.names
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_line"]])
    raw = spark.read.schema(text).options(
        **{**_CSV, "header": str(header).lower()}, mode="PERMISSIVE", columnNameOfCorruptRecord="_line", enforceSchema="true",
        columnPruning="false",
    ).csv(path)
    # Only rows Spark flags for a wrong number of values carry their line. Cut at its
    # quotes, every second piece lies outside them; doubled quotes leave an empty one.
    outside = F.array_join(F.filter(F.split("_line", '"'), lambda _, i: i % 2 == 0), "")
    values = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    short = F.coalesce(values < len(names), F.lit(False))
    bad, reason = short, F.when(short, F.lit("too few values"))
    cast: list[Column] = []
    for field in schema.fields:
        typed = F.col(field.name).try_cast(field.dataType)
        cast.append(typed.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            wrong = F.col(field.name).isNotNull() & typed.isNull()
            bad, reason = bad | wrong, reason.when(wrong, F.lit(f"{field.name} is no {field.dataType.simpleString()}"))
    row = F.coalesce(F.col("_line"), F.to_csv(F.struct(*names)))
    return raw.select(*cast, bad.alias("_bad"), F.when(bad, row).alias("_row"), reason.alias("_reason"))


def load_staging(spark: SparkSession, path: str, schema: T.StructType, table: str,
                 max_bad: int = MAX_BAD, ts: str | None = "created_at",
                 header: bool = True) -> DataFrame:
    """Replaces a staging table by a CSV folder, allowing ``max_bad`` rejected rows.

    The file is parsed once: the rejected rows are counted while the others are
    written aside, and they reach the table only if the rejected are few enough.
    Rejected rows, if any, go to ``<table>__rejected`` with their reason.
    A missing path raises ``FileNotFoundError``.
    """
    try:
        parsed = parse_staging(spark, path, schema, header)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise
    seen = Observation()
    counted = parsed.observe(seen, F.count_if("_bad").alias("bad"))
    aside = beside(table, "parsed")
    write_partitioned(counted.where(~F.col("_bad")).select(schema.names), aside, None)
    rejected = seen.get["bad"]
    if rejected > max_bad:
        # Work repeated after a lost executor is observed twice, so count again.
        rejected = parsed.agg(F.count_if("_bad")).first()[0]
    refused = f"{table}__rejected"
    spark.sql(f"DROP TABLE IF EXISTS {refused}")
    if rejected:
        lines = parsed.where("_bad").select(F.col("_row").alias("line"), F.col("_reason").alias("reason"))
        write_partitioned(lines, refused, None)
    if rejected <= max_bad:
        write_partitioned(spark.table(aside), table, ts)
    spark.sql(f"DROP TABLE {aside}")
    if rejected > max_bad:
        raise TooManyBadRows(f"{rejected} rejected rows in {path}, {max_bad} allowed")
    return stored(spark, table)


# --- merges into stored tables -----------------------------------------------------------
def append_new_rows(staging: DataFrame, table: str, key: str, ts: str = "created_at",
                    hot: Hot = Hot()) -> None:
    """Insert-only merge into a stored table: appends the new rows, rewrites nothing.

    Only target rows between the smallest and largest staged key can match. Keys
    mostly grow with time, so file statistics rule out all but the newest files.
    """
    spark = staging.sparkSession
    ensure_table(spark, table, staging.schema, ts)
    target = _within(stored(spark, table), staging, key)
    fresh = new_rows(target, staging, key, ts, hot).select(target.columns)
    write_partitioned(fresh, table, ts, mode="append")


def _within(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target rows whose key lies in the key range of the batch."""
    low, high = batch.agg(F.min(key), F.max(key)).first()
    return target.where(F.col(key).between(low, high)) if low is not None else target.limit(0)


def upsert_table(delta: DataFrame, table: str, keys: list[str], ts: str | None = "created_at",
                 null_safe: bool = False, day: str = DAY, checked: bool = False,
                 before: Callable[[set], None] | None = None) -> set:
    """Upserts into a stored table, rewriting only the days it touches, which it returns.

    ``ts=None`` is for small tables not stored by day, which are replaced. The
    delta must be cheap to read again, such as a stored table. Raises
    ``AmbiguousMerge`` if two delta rows claim one target row, unless ``checked``.
    ``before`` is told the days before any of them is written.
    """
    spark = delta.sparkSession
    target = spark.table(table)
    if ts is None:
        with ambiguous():
            write_partitioned(upsert(target, delta.select(target.columns), keys, null_safe, checked, stored=True), table, None)
        return set()
    delta = delta if ts == day else delta.withColumn(day, F.to_date(ts))
    delta = delta.select(target.columns)
    low, high, arriving = _extent(delta, keys[0], day)
    # A replaced row may lie on another day than its replacement.
    touched = arriving
    if day not in keys and arriving:
        within = target if null_safe else target.where(F.col(keys[0]).between(low, high))
        touched = arriving | _days(
            matched(within.select(*keys, day), delta, keys, null_safe), day
        )
    if not touched:
        return touched
    if before:
        before(touched)
    content = upsert(target.where(on_days(day, touched)), delta, keys, null_safe, checked, stored=True)
    with ambiguous():
        present = _overwrite_days(_by_day(content, day, day)[0], table, day)
    _drop_days(spark, table, day, touched - present)
    return touched


def _extent(delta: DataFrame, key: str, day: str) -> tuple:
    """Least and greatest key and the days of a delta, in one pass."""
    row = delta.agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.collect_set(day).alias("days"),
        F.count_if(F.col(day).isNull()).alias("without"),
    ).first()
    return row["low"], row["high"], set(row["days"]) | ({None} if row["without"] else set())


def _days(df: DataFrame, day: str) -> set:
    """The distinct days of a DataFrame; a table has one folder for each."""
    return {row[0] for row in df.select(day).distinct().collect()}


def _ranges(days: set) -> list[tuple[date, date]]:
    """The days, but ``None``, as first and last day of unbroken ranges."""
    ranges: list[tuple[date, date]] = []
    for value in sorted(d for d in days if d is not None):
        if ranges and value - ranges[-1][1] == timedelta(days=1):
            ranges[-1] = ranges[-1][0], value
        else:
            ranges.append((value, value))
    return ranges


def on_days(day: str, days: set) -> Column:
    """Condition on a storage day, by ranges, with ``None`` for rows without one."""
    chosen = F.col(day).isNull() if None in days else F.lit(False)
    ranges = _ranges(days)
    single = [low for low, high in ranges if low == high]
    if single:
        chosen = chosen | F.col(day).isin(single)
    for low, high in ranges:
        if low != high:
            chosen = chosen | F.col(day).between(F.lit(low), F.lit(high))
    return chosen


def within_days(ts: str, days: set) -> Column:
    """Condition on a time that lies on one of ``days``, by ranges that reach the files'
    statistics, with ``None`` for rows without a time."""
    chosen = F.col(ts).isNull() if None in days else F.lit(False)
    for low, high in _ranges(days):
        start, end = (F.to_timestamp_ntz(F.lit(f"{d} 00:00:00")) for d in (low, high + timedelta(days=1)))
        chosen = chosen | ((F.col(ts) >= start) & (F.col(ts) < end))
    return chosen


# --- metrics ----------------------------------------------------------------------------------
def append_metrics(df: DataFrame | None, table: str) -> bool:
    """Appends snapshots if they hold no NULL at all; tells whether it did.

    Nothing to load, or a single NULL anywhere, leaves the table as it is.
    """
    if df is None:
        return False
    nulls = F.lit(False)
    for name in df.columns:
        nulls = nulls | F.col(f"`{name}`").isNull()
    check = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(nulls).alias("nulls")).first()
    ensure_table(df.sparkSession, table, df.schema, None)
    if check["rows"] == 0 or check["nulls"]:
        return False
    df.select(df.sparkSession.table(table).columns).write.insertInto(table)
    return True
