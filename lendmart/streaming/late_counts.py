"""Daily counts of a stream that lose no late row.

Days close as the watermark passes them: the newest time of all earlier batches less a
delay. Rows of a day that is open are counted per batch; rows of a closed day go whole to a
side table, from which ``merge_late`` brings the closed days up to date. Every table is
written by batch number or by day, and a batch's own mark is written last, so a batch that is
delivered again after a failure replaces what it wrote and counts nothing twice.

| table | content | stored by |
| --- | --- | --- |
| ``<table>`` | counts of closed days, late rows merged in | day |
| ``<table>__on_time`` | counts as they were when the day closed | day |
| ``<table>__open`` | counts of open days, per batch | day, batch |
| ``<table>__late`` | late rows and rows without a time, whole | batch |
| ``<table>__marks`` | the watermark after each of the last batches | batch |
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.landing import drop_parts, on_days, put_parts, table_exists

DAY, BATCH = "day", "batch"
# Marks of earlier batches that stay.
MARKS_KEPT = 10


def side(table: str, name: str) -> str:
    return f"{table}__{name}"


def watermark(spark: SparkSession, table: str, batch: int | None = None) -> datetime | None:
    """The watermark that holds for a batch: the mark of the last one before it."""
    marks = side(table, "marks")
    if not table_exists(spark, marks):
        return None
    before = spark.table(marks) if batch is None else spark.table(marks).where(F.col(BATCH) < batch)
    return before.agg(F.max("mark")).first()[0]


def _closed(mark: datetime | None):
    """Condition on rows whose day the mark has passed."""
    if mark is None:
        return F.lit(False)
    return F.col(DAY) < F.lit(mark.date())


def count_batch(batch: DataFrame, number: int, table: str, ts: str, by: list[str], delay: str, name: str) -> None:
    """Takes in one micro-batch."""
    spark = batch.sparkSession
    mark = watermark(spark, table, number)
    rows = batch.withColumn(DAY, F.to_date(ts)).withColumn(BATCH, F.lit(number).cast("long")).persist()
    try:
        newest = rows.agg(F.expr(f"CAST(max({ts}) AS TIMESTAMP_NTZ) - INTERVAL {delay}").alias("mark")).first()["mark"]
        late = _closed(mark) | F.col(DAY).isNull()
        counts = rows.where(~late).groupBy(DAY, BATCH, *by).agg(F.count(F.lit(1)).alias(name))
        put_parts(counts.select(*by, name, DAY, BATCH), side(table, "open"), [DAY, BATCH])
        put_parts(rows.where(late).select(*[c for c in rows.columns if c != BATCH], BATCH), side(table, "late"), [BATCH])
    finally:
        rows.unpersist()
    after = max((m for m in (mark, newest) if m is not None), default=None)
    if after is None:
        return
    _close(spark, table, mark, after, by, name)
    marks = side(table, "marks")
    put_parts(spark.createDataFrame([(after, number)], f"mark timestamp_ntz, {BATCH} long"), marks, [BATCH])
    drop_parts(spark, marks, lambda part: int(part[BATCH]) < number - MARKS_KEPT)


def _close(spark: SparkSession, table: str, before: datetime | None, after: datetime, by: list[str], name: str) -> None:
    """Adds up the days that the mark passes now. What it passed earlier is cleared away."""
    open_ = spark.table(side(table, "open"))
    passed = F.col(DAY) < F.lit(after.date())
    if before is not None:
        passed &= F.col(DAY) >= F.lit(before.date())
    done = open_.where(passed).groupBy(DAY, *by).agg(F.sum(name).alias(name)).select(*by, name, DAY)
    put_parts(done, side(table, "on_time"), [DAY])
    put_parts(spark.table(side(table, "on_time")).where(passed), table, [DAY])
    if before is not None:
        drop_parts(spark, side(table, "open"), lambda part: part[DAY] < str(before.date()))


def stream_counts_with_late(src: DataFrame, table: str, ts: str, by: list[str], checkpoint: str, delay: str = "1 day",
                            name: str = "rows", **trigger) -> StreamingQuery:
    """Counts a stream per day and ``by`` into ``table``; late rows go to the side table.

    One writer a table. The counts of the open days are the state: a row per day, group and
    batch, whatever the number of rows.
    """

    def take(batch: DataFrame, number: int) -> None:
        count_batch(batch, number, table, ts, by, delay, name)

    return (
        src.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def merge_late(spark: SparkSession, table: str, by: list[str], name: str = "rows") -> set:
    """Brings closed days up to date with all late rows; returns the days rewritten.

    They are made from the counts on time and the late rows each time, so merging twice
    changes nothing.
    """
    late = spark.table(side(table, "late")).where(F.col(DAY).isNotNull())
    counts = late.groupBy(DAY, *by).agg(F.count(F.lit(1)).alias(name)).select(*by, name, DAY)
    days = {row[0] for row in counts.select(DAY).distinct().collect()}
    if days:
        on_time = spark.table(side(table, "on_time")).where(on_days(DAY, days)).select(*by, name, DAY)
        merged = on_time.unionAll(counts).groupBy(DAY, *by).agg(F.sum(name).alias(name))
        put_parts(merged.select(*by, name, DAY), table, [DAY])
    return days


def late_report(spark: SparkSession, table: str) -> DataFrame:
    """(day, late_rows) of the rows that came after their day closed or without a time."""
    return spark.table(side(table, "late")).groupBy(DAY).agg(F.count(F.lit(1)).alias("late_rows"))
