"""Structured Streaming forms of the scheduled jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.digests import row_hash
from ..sources.landing import append_new_rows, beside, drop_table, write_partitioned

# Files of one micro-batch, so a batch stays as large as it was in tests after an outage.
FILES_PER_BATCH = 200


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 files: int = FILES_PER_BATCH, **options: str) -> DataFrame:
    """A stream of the files that reach a folder, ``files`` of them a micro-batch at most."""
    return spark.readStream.schema(schema).format(fmt).options(maxFilesPerTrigger=files, **options).load(path)


def without_redeliveries(src: DataFrame, key: str, within: str) -> DataFrame:
    """Rows of a stream, each once however often it comes again ``within`` of its arrival.

    A row is known by its key and a hash of all its columns, so a differing row of the same
    key passes. The state is bounded by arrival, not by the rows' own times: no row is ever
    too late to pass, and a row's entry leaves the state after ``within``.
    """
    return (
        src.withColumns({"__arrived": F.current_timestamp(), "__row": row_hash(src.columns)})
        .withWatermark("__arrived", within)
        .dropDuplicatesWithinWatermark([key, "__row"])
        .select(*[F.col(f"`{c}`") for c in src.columns])
    )


def stream_insert_only(src: DataFrame, table: str, key: str, checkpoint: str,
                       ts: str = "created_at", within: str | None = None, **trigger) -> StreamingQuery:
    """Keeps an insert-only table up to date from a stream of rows.

    A micro-batch may be delivered again after a failure. Each one is merged by
    key, never blindly appended, so a repeat changes nothing. With ``within``, rows that
    come again in that time are dropped by a bounded state ahead of the merge, and a batch
    of nothing else does not read the table. The batch is staged as a table: it is read for
    its key range, its keys and its rows. ``stream_files`` bounds its size.
    """
    rows = without_redeliveries(src, key, within) if within else src

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        staged = beside(table, "batch")
        write_partitioned(batch, staged, None)
        if not spark.table(staged).isEmpty():
            append_new_rows(spark.table(staged), table, key, ts)
        drop_table(spark, staged)

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_daily_counts(src: DataFrame, ts: str, by: list[str], delay: str = "1 day",
                        name: str = "rows") -> DataFrame:
    """Rows per day and ``by``; rows later than ``delay`` are dropped (``late_counts`` keeps
    them).

    Counts are combined per task before the shuffle, and a day leaves the state
    once the watermark has passed it. Watermarks need an instant, so zoneless
    times are read as UTC, whatever the session zone.
    """
    zone = F.current_timezone()
    return (
        src.withColumn("_time", F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone))
        .withWatermark("_time", delay)
        .groupBy(F.window("_time", "1 day").alias("_day"), *by)
        .agg(F.count(F.lit(1)).alias(name))
        .select(F.to_date(F.to_utc_timestamp("_day.start", zone)).alias("day"), *by, name)
    )


def write_days(counts: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Appends closed days to Parquet files, exactly once."""
    return (
        counts.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
