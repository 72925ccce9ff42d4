"""What the operators share: stored tables, Arrow row steps, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from lendmart.session import shared_folder

# How many documents a row step holds as Python values at a time.
SLICE_ROWS = 256


def ship(spark: SparkSession) -> None:
    """Sends the package's code along, so executors need no install of it.

    Functions then travel as names, and what a worker has loaded (a tokenizer's tables)
    serves all its tasks.
    """
    root = Path(__file__).resolve().parents[1]
    name = f"{root.name}-code.zip"
    if name in spark.sparkContext._python_includes:
        return
    target = Path(tempfile.mkdtemp(prefix=f"{root.name}-")) / name
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs a read, not the steps before. The table is
    removed when the driver ends.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    context = df.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(
    df: DataFrame, columns: list[str], make: Callable[[], Callable[..., list[tuple]]], schema: str
) -> DataFrame:
    """An Arrow step over ``columns``: ``make()`` runs once per task and gives a function
    from lists of the columns' values to output rows, whatever their number.

    Rows are turned into Python values ``SLICE_ROWS`` at a time, so memory does not follow
    the size of an Arrow batch.
    """
    kind: StructType = _parse_datatype_string(schema)
    out = to_arrow_schema(kind)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(start, SLICE_ROWS)
                rows = work(*(piece.column(i).to_pylist() for i in range(len(columns))))
                if rows:
                    arrays = [pa.array(v, f.type) for v, f in zip(zip(*rows), out)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=out)

    ship(df.sparkSession)
    plain = df.select(*quoted(columns)).toDF(*[f"c{k}" for k in range(len(columns))])  # any names
    return plain.mapInArrow(step, kind)


def quoted(columns: list[str]) -> list[str]:
    """Column names that hold dots or blanks as they are."""
    return [f"`{c}`" for c in columns]


def new_column(df: DataFrame, name: str | None) -> None:
    """Refuses a column that would be there twice."""
    if name and name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the table has a column {name} already")


def any_of(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long, not null): nodes have the same
    root exactly if edges connect them. The root is one of the component's nodes.

    Random contraction: in each round every node moves to the closed neighbour of least
    hashed rank and the edges between different targets go on, so a constant share of the
    nodes is expected to vanish per round whatever the shape of the graph. Minima are
    combined before the shuffle, so a node with very many edges stays cheap. Every round is
    stored, and nothing but "are there edges left" reaches the driver.
    """
    moves = []
    left = stored(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        purpose,
    )
    while not left.isEmpty():
        rank = lambda c: F.xxhash64(F.lit(len(moves)), c)
        both = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = stored(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min_by("b", rank("b")).alias("near"))
            .select("node", F.when(rank("near") < rank("node"), F.col("near")).otherwise(F.col("node")).alias("root")),
            purpose,
        )
        moves.append(move)
        from_a = move.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        from_b = move.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = stored(
            left.join(from_a, "a").join(from_b, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            purpose,
        )
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = moves.pop()
    while moves:
        later = labels.select(F.col("node").alias("root"), F.col("root").alias("last"))
        labels = moves.pop().join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    return stored(labels, purpose)
