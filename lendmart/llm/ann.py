"""Nearest neighbours by collision counting over single projections.

Rows are dealt into blocks by a hash of their id. A block's index holds, for every one of
``PROJECTIONS`` random directions, the rows sorted by their projection. A query opens a
window around its own projection in each of the sorted arrays; the window grows with the
search radius (virtual rehashing, nothing is hashed again). Rows that lie in at least
``THRESHOLD`` of the windows are verified by their exact cosine, all of them, however many.
A block is done when its k-th best lies within the radius; beyond the largest distance that
unit vectors can have, all rows count as found. Blocks' results meet in one top-k.

Every row is indexed. A block's index moves once, to a partition of its own, and single
query rows travel there behind it, so nothing is joined, neither side is broadcast and no
task holds more than one block and one Arrow batch of queries. While there are fewer
blocks than the cores could take, a block goes to several partitions, each with a share of
the queries.

Defined results: null or zero vectors and those with null or non-finite components take no
part, neither as queries nor as candidates. Of rows with the same id the least vector
counts. Vectors of different lengths are not compared. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendmart.llm.common import ship, stored

PROJECTIONS = 64
THRESHOLD = 0.65
#: Half a window's width in units of the radius.
REACH = 1.1
RADII = tuple(0.25 * 1.35**k for k in range(8))
BLOCK_ROWS = 8192
GROUP_QUERIES = 256
#: Partitions at most: what the driver keeps of a shuffle must not follow the rows.
MOST_PARTITIONS = 4096
TASKS_A_CORE = 3
SEED = 11


def directions(dim: int, projections: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((projections, dim))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, dim): the rows that take part, components in double precision."""
    v = F.col("v")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        .where(F.col("id").isNotNull() & v.isNotNull())
        .where(whole & F.exists(v, lambda x: x != 0))
        .withColumn("dim", F.size("v"))
    )


def _unit(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Dot product over the product of lengths, each row summed in the same order."""
    dots = (rows * query).sum(axis=1)
    return dots / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def _levelled(matrix: np.ndarray) -> np.ndarray:
    """Each row by the power of two that brings its largest component to a half or more.

    Scaling by a power of two rounds nothing, so cosines stay the same to the last bit,
    and squares of very large or small components neither over- nor underflow.
    """
    exponent = np.frexp(np.abs(matrix).max(axis=1, keepdims=True))[1]
    return np.ldexp(matrix, -exponent)


def _pack(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids in order and their vectors, levelled; of equal ids the least vector."""
    best: dict[int, tuple] = {}
    for i, v in zip(rows["id"], rows["v"]):
        if (key := tuple(v)) < best.get(i, (float("inf"),)):
            best[i] = key
    ids = sorted(best)
    return np.array(ids, np.int64), _levelled(np.array([best[i] for i in ids], np.float64))


def build_index(rows: DataFrame, blocks: int) -> DataFrame:
    """One row per block: (dim, block, ids, vectors, order, places), arrays as bytes."""

    def index(group: pd.DataFrame) -> pd.DataFrame:
        ids, vectors = _pack(group)
        projected = (_unit(vectors) @ directions(vectors.shape[1]).T).T
        order = np.argsort(projected, axis=1, kind="stable")
        places = np.take_along_axis(projected, order, axis=1).astype(np.float32)
        return pd.DataFrame({
            "dim": [vectors.shape[1]], "block": [int(group["block"].iloc[0])], "ids": [ids.tobytes()],
            "vectors": [vectors.tobytes()], "order": [order.astype(np.int32).tobytes()], "places": [places.tobytes()],
        })

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    schema = "dim int, block int, ids binary, vectors binary, order binary, places binary"
    return dealt.repartition(min(blocks, MOST_PARTITIONS), "dim", "block").groupBy("dim", "block").applyInPandas(index, schema)


def search(ids, vectors, order, places, query_ids, queries, k: int) -> list[tuple[int, int, float]]:
    """(query, id, cosine): the k best found in the block for each query."""
    n, m = len(ids), len(order)
    need = int(np.ceil(THRESHOLD * m))
    centre = _unit(queries) @ directions(vectors.shape[1], m).T
    edges = []
    for radius in RADII:
        low, high = (np.empty((m, len(queries)), np.int64) for _ in range(2))
        for i in range(m):
            low[i] = np.searchsorted(places[i], centre[:, i] - REACH * radius)
            high[i] = np.searchsorted(places[i], centre[:, i] + REACH * radius)
        edges.append((low, high))
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    out = []
    for q, query_id in enumerate(query_ids):
        asked = queries[q] / np.sqrt((queries[q] * queries[q]).sum())
        hits, seen = np.zeros(n, np.int64), np.zeros(n, bool)
        found, scores = np.zeros(0, np.int64), np.zeros(0)
        old_low = old_high = None
        own = ids == query_id
        seen[own] = True
        wanted = min(k, n - int(own.sum()))
        for radius, (low, high) in zip([*RADII, None], [*edges, (None, None)]):
            if radius is None:
                new = np.flatnonzero(~seen)
            else:
                a, b = low[:, q], high[:, q]
                if old_low is None:
                    parts = [order[i, a[i] : b[i]] for i in range(m)]
                else:
                    parts = [order[i, a[i] : old_low[i]] for i in range(m)]
                    parts += [order[i, old_high[i] : b[i]] for i in range(m)]
                hits += np.bincount(np.concatenate(parts), minlength=n)
                old_low, old_high = a, b
                new = np.flatnonzero((hits >= need) & ~seen)
            if len(new):
                seen[new] = True
                found = np.concatenate([found, new])
                scores = np.concatenate([scores, vectors[new] @ asked / lengths[new]])
            if len(found) >= wanted:
                if not wanted:
                    break
                kth = np.partition(scores, -wanted)[-wanted]
                if radius is not None and 2 - 2 * kth <= radius * radius:
                    break
        if wanted:  # the exact sums for all that rounding could bring among the best
            found = found[scores >= np.partition(scores, -wanted)[-wanted] - 1e-9]
        scores = cosines(vectors[found], queries[q])
        best = np.lexsort((ids[found], -scores))[:k]
        out += [(int(query_id), int(ids[found[j]]), float(scores[j])) for j in best]
    return out


def _comparison(k: int, together: int):
    """A step over partitions in which a block's index row stands before its query rows."""
    kind = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index = None, ()
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("share", "block", "dim")])
            is_index = batch.column("query_id").is_null().to_numpy(zero_copy_only=False)
            starts = np.ones(batch.num_rows, bool)
            starts[1:] = is_index[1:] | is_index[:-1] | (keys[:, 1:] != keys[:, :-1]).any(axis=0)
            at = np.flatnonzero(starts)
            for start, end in zip(at, [*at[1:], batch.num_rows]):
                if is_index[start]:
                    held, index = tuple(keys[:, start]), _unpacked(batch, start)
                    continue
                if tuple(keys[:, start]) != held:  # no row of that length lies in the block
                    continue
                for first in range(start, end, together):
                    some = batch.slice(first, min(together, end - first))
                    queries = np.frombuffer(b"".join(some.column("query").to_pylist()), np.float64)
                    query_ids = some.column("query_id").to_numpy()
                    found = search(*index, query_ids, queries.reshape(len(query_ids), -1), k)
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(v, f.type) for v, f in zip(zip(*found), kind)], schema=kind
                        )

    return compare


def _unpacked(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, vectors, order, places) of an index row, for ``search``."""
    part = lambda name, kind: np.frombuffer(batch.column(name)[row].as_py(), kind)
    ids = part("ids", np.int64)
    n = len(ids)
    order = part("order", np.int32).astype(np.int64).reshape(-1, n)
    return ids, part("vectors", np.float64).reshape(n, -1), order, part("places", np.float32).reshape(-1, n)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, id, score): each query row's k nearest by cosine."""
    spark = vectors.sparkSession
    ship(spark)
    asked = vectors.where(is_query)
    rows, queries = usable(vectors, id_col, vector_col), usable(asked, id_col, vector_col)
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    groups = max(1, -(-queries.count() // GROUP_QUERIES))
    shares = min(groups, -(-TASKS_A_CORE * spark.sparkContext.defaultParallelism // blocks))
    index = stored(build_index(rows, blocks), "ann")

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        ids, matrix = _pack(group)
        return pd.DataFrame({"dim": matrix.shape[1], "query_id": ids, "query": [v.tobytes() for v in matrix]})

    single = (
        queries.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
        .groupBy("dim", "part").applyInPandas(gather, "dim int, query_id long, query binary")
        .withColumn("share", F.pmod(F.xxhash64("query_id"), F.lit(shares)).cast("int"))
    )
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    both = index.withColumn("share", each(shares)).unionByName(
        single.withColumn("block", each(blocks)), allowMissingColumns=True
    )
    # Only an index row has no query_id, so it comes first of its block.
    dealt = both.repartitionById(
        min(blocks * shares, MOST_PARTITIONS), F.col("block") * shares + F.col("share")
    ).sortWithinPartitions("share", "block", "dim", F.asc_nulls_first("query_id"))
    best = dealt.mapInArrow(_comparison(k, GROUP_QUERIES), "query_id long, id long, score double")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        best.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
