"""Reading operational tables, daily slices and stored pages."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, time, timedelta
from decimal import Decimal
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import second_text
from ..schemas import SOURCES, TIMESTAMP_COLUMNS

# Fixed value: the zone whose calendar decides which day is extracted.
SLICE_ZONE = "Asia/Jakarta"


def slice_day(now: datetime | None = None, tz: str = SLICE_ZONE) -> date:
    """Yesterday in ``tz``. Pass ``now`` to repeat an earlier run."""
    zone = ZoneInfo(tz)
    now = datetime.now(zone) if now is None else now.astimezone(zone)
    return now.date() - timedelta(days=1)


def slice_bounds(day: date | str, exact: bool = False) -> tuple[datetime, datetime]:
    """First instant of the slice and the first one after it.

    The slice ends before 23:59:59, so a day's last second is left out;
    ``exact=True`` takes the whole day.
    """
    day = date.fromisoformat(day) if isinstance(day, str) else day
    start = datetime.combine(day, time())
    return start, start + timedelta(days=1) - timedelta(seconds=0 if exact else 1)


def slice_predicates(day: date | str, parts: int, ts: str = "created_at",
                     exact: bool = False) -> list[str]:
    """SQL conditions that cut one slice into ``parts`` gapless time ranges."""
    start, end = slice_bounds(day, exact)
    cuts = [start + (end - start) * i / parts for i in range(parts)] + [end]
    return [f"{ts} >= '{low}' AND {ts} < '{high}'" for low, high in zip(cuts, cuts[1:])]


# --- splitting a whole table by its keys ------------------------------------------
# Rows a JDBC connection fetches at a time; the drivers' own defaults are ten, or all.
FETCH_ROWS = 10_000


def _literal(value) -> str:
    """A key value as an SQL literal."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"no split point: {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, (datetime, date)):
        return f"'{value.isoformat(sep=' ') if isinstance(value, datetime) else value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def split_query(table: str, keys: Sequence[str], parts: int) -> str:
    """SQL for the points that cut a table into ``parts`` ranges of as many rows each.

    The database numbers the rows by key (an index scan, if it has one) and returns the
    first key of every range but the first, with its place: ``parts - 1`` rows at most. Their
    order is the database's, which may not be that of their text. With several keys the
    later ones cut ranges within one value of the earlier, so a value that very many
    rows share is cut as well.
    """
    names, present = ", ".join(keys), " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT {names}, place_ FROM (SELECT {names}, ROW_NUMBER() OVER (ORDER BY {names}) AS place_, "
        f"COUNT(*) OVER () AS rows_ FROM {table} WHERE {present}) numbered_ "
        f"WHERE place_ > 1 AND MOD(place_ - 1, CAST(CEIL(rows_ * 1.0 / {parts}) AS INTEGER)) = 0"
    )


def split_points(df: DataFrame, key: str, parts: int) -> list[tuple]:
    """The same for a table Spark reads itself: quantiles of a number or time, from one
    sketch a task, which stays small whatever the number of rows."""
    if parts < 2:
        return []
    share = [k / parts for k in range(1, parts)]
    accuracy = 100 * parts
    found = df.agg(F.percentile_approx(key, share, accuracy)).first()[0] or []
    return [(value,) for value in found]


def split_predicates(keys: Sequence[str], points: Iterable[Sequence]) -> list[str]:
    """SQL conditions that deal every row of a table to exactly one range of its keys.

    ``points`` come in the order of the keys; a repeated one counts once. Keys compare one
    after the other, as in an index. Rows with a NULL in their keys have a condition of
    their own, the last.
    """
    cuts = list(dict.fromkeys(tuple(p) for p in points))

    def below(cut: tuple) -> str:
        ways, same = [], []
        for key, value in zip(keys, cut):
            ways.append(" AND ".join([*same, f"{key} < {_literal(value)}"]))
            same.append(f"{key} = {_literal(value)}")
        return "(" + " OR ".join(f"({w})" for w in ways) + ")"

    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    ranges = [
        " AND ".join(filter(None, [present, low and f"NOT {below(low)}", high and below(high)]))
        for low, high in zip([None, *cuts], [*cuts, None])
    ]
    return [*ranges, " OR ".join(f"{k} IS NULL" for k in keys)]


def read_source(spark: SparkSession, name: str, fmt: str = "parquet", *,
                day: date | str | None = None, parts: int = 8, exact: bool = False,
                split_by: Sequence[str] = (), **opts) -> DataFrame:
    """One source table with all its columns.

    Files: ``path`` is the folder that holds ``<table>.<fmt>``. JDBC: ``url``,
    optionally ``namespace`` and connection properties (``fetchsize`` is ``FETCH_ROWS``
    unless given); with ``day`` the slice is read over ``parts`` connections, each fetching
    its own time range. A whole table is read over ``parts`` connections if ``split_by``
    names its keys: a first query asks the database for ranges of equal weight.
    """
    table = SOURCES.get(name, name)
    if fmt == "jdbc":
        url = opts.pop("url")
        namespace = opts.pop("namespace", None)
        reader = spark.read.options(**{"preferTimestampNTZ": "true", "fetchsize": str(FETCH_ROWS), **opts})
        target = f"{namespace}.{table}" if namespace else table
        if day is None and split_by:
            found = reader.jdbc(url, f"({split_query(target, split_by, parts)}) points_").collect()
            points = [row[:-1] for row in sorted(found, key=lambda row: row[-1])]
            return reader.jdbc(url, target, predicates=split_predicates(split_by, points))
        if day is None:
            return reader.jdbc(url, target)
        return reader.jdbc(url, target, predicates=slice_predicates(day, parts, exact=exact))
    path = opts.pop("path")
    df = spark.read.format(fmt).options(**opts).load(f"{path}/{table}.{fmt}")
    return df if day is None else daily_slice(df, day, exact=exact)


class EmptySlice(ValueError):
    """A day without a single row."""


def daily_slice(df: DataFrame, day: date | str, ts: str = "created_at", exact: bool = False,
                on_empty: str = "skip") -> DataFrame:
    """Rows of one day. The two literal bounds reach the file or JDBC scan.

    ``on_empty="error"`` raises ``EmptySlice``, as an empty batch stops the load.
    """
    start, end = slice_bounds(day, exact)
    sliced = df.where((F.col(ts) >= _instant(start)) & (F.col(ts) < _instant(end)))
    if on_empty == "error" and sliced.isEmpty():
        raise EmptySlice(f"no rows on {day}")
    return sliced


def _instant(value: datetime):
    return F.to_timestamp_ntz(F.lit(value.isoformat(sep=" ")))


def normalize_ts(df: DataFrame, cols=TIMESTAMP_COLUMNS) -> DataFrame:
    """Epoch milliseconds or timestamps as second-precision text, where present."""
    types = dict(df.dtypes)
    return df.withColumns(
        {name: second_text(F.col(name), types[name]) for name in cols if name in types}
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages (page_id, url, html), read as the files lie; ``spark.sql.files``
    settings decide how finely they are split."""
    return spark.read.parquet(path)
