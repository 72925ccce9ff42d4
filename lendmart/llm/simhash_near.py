"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are made in one Arrow step per document. Distinct fingerprints are dealt into
tiles by the population counts of their four 16-bit quarters (two for the tile, all four for
the strips inside it). Two fingerprints differ in at least as many bits as their quarter
counts do, so pairs of tiles and of strips beyond the radius are skipped; the rest are
compared in full with numpy exclusive-or and bit counts. A tile pair passes on a spanning
forest of its links, never all of them; the forests' components are the groups.

Defined results: a text without words (null, empty or blank) has fingerprint zero and links
like any other. Fewer words than a shingle form one shingle. Repeated rows share a
fingerprint and so a group; a null id takes part but names no group unless nothing else can.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lendmart.llm.common import components, map_rows, ship, stored

SHINGLE = 4
RADIUS = 4
SEED = 42
STRIP = 256
BINS = 17 * 17
# Tiles per square root of the number of fingerprints. Tiles and their number then both
# grow with the square root: a tile of a billion fingerprints takes some 4 MB.
TILES_PER_ROOT = 1 / 16

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACES = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint: a bit is set if it is in over half the shingles' hashes."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    n = max(1, len(words) - shingle + 1)
    starts = (ends - sizes)[:n].tolist()
    stops = (ends - 1)[len(words) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    octets = hashes.view(np.uint8).reshape(n, 8) + _PLACES
    counts = np.bincount(octets.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits(2 * counts.ravel() > n, bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """(id, print) per row of ``docs``; the fingerprint as the signed long of its bits.
    ``row_col``, a long, is passed on in front."""

    def make():
        def work(*columns):
            prints = (fingerprint(t, shingle) for t in columns[-1])
            return [(*own, p - (p >> 63 << 64)) for *own, p in zip(*columns[:-1], prints)]

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    row = [row_col] if row_col else []
    schema = "".join(f"`{c}` long, " for c in row) + f"`{id_col}` {kind}, print long"
    return map_rows(docs, [*row, id_col, text_col], make, schema)


def _quarters(prints: np.ndarray) -> np.ndarray:
    parts = prints.astype(np.uint64)[:, None] >> np.array([0, 16, 32, 48], np.uint64) & np.uint64(0xFFFF)
    return np.bitwise_count(parts).astype(np.int16)


def _join(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Lowers ``labels`` in place until both ends of every link carry the same one."""
    while True:
        low, high = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
        open_ = low < high
        if not open_.any():
            return
        np.minimum.at(labels, high[open_], low[open_])
        while not np.array_equal(up := labels[labels], labels):
            labels[:] = up
        a, b = a[open_], b[open_]


def link_tiles(one: np.ndarray, other: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links that connect what pairs within ``radius`` bits connect: between the tiles, or
    inside ``one`` if ``other`` is None."""
    sides, strips = [], []
    base = 0
    for tile in [one] if other is None else [one, other]:
        counts = _quarters(tile)
        order = np.lexsort(counts.T[::-1])
        tile, counts = tile[order].view(np.uint64), counts[order]
        cuts = np.arange(0, len(tile), STRIP)
        sides.append(tile)
        strips.append((
            cuts + base, np.append(cuts[1:], len(tile)) + base,
            np.minimum.reduceat(counts, cuts), np.maximum.reduceat(counts, cuts),
        ))
        base += len(tile)
    values = np.concatenate(sides)
    labels = np.arange(len(values))
    (from_a, to_a, low_a, high_a), (from_b, to_b, low_b, high_b) = strips[0], strips[-1]
    apart = np.maximum(low_a[:, None] - high_b[None], low_b[None] - high_a[:, None])
    near = np.maximum(apart, 0).sum(axis=2) <= radius
    for i, j in zip(*np.nonzero(np.triu(near) if other is None else near)):
        own, their = slice(from_a[i], to_a[i]), slice(from_b[j], to_b[j])
        left, right = labels[own], labels[their]
        if left[0] == right[0] and (left == left[0]).all() and (right == left[0]).all():
            continue  # already one group
        found = np.nonzero(np.bitwise_count(values[own, None] ^ values[None, their]) <= radius)
        _join(labels, found[0] + from_a[i], found[1] + from_b[j])
    moved = np.flatnonzero(labels != np.arange(len(labels)))
    signed = values.view(np.int64)
    return list(zip(signed[moved].tolist(), signed[labels[moved]].tolist()))


def _bin(p: Column) -> Column:
    low, next_ = p.bitwiseAND(F.lit(0xFFFF)), F.shiftrightunsigned(p, 16).bitwiseAND(F.lit(0xFFFF))
    return F.bit_count(low) * 17 + F.bit_count(next_)


def print_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect the distinct ``print`` values as all pairs within
    ``radius`` bits would.

    The driver sees counts per pair of quarter counts only: 289 at most.
    """
    counts = np.zeros(BINS, np.int64)
    for row in prints.groupBy(_bin(F.col("print")).alias("bin")).count().collect():
        counts[row["bin"]] = row["count"]
    total = int(counts.sum())
    tiles = max(1, math.ceil(math.sqrt(total) * TILES_PER_ROOT))
    size = max(1, -(-total // tiles))
    starts = np.cumsum(counts) - counts
    member = np.zeros((tiles, BINS), bool)
    for b in np.flatnonzero(counts):
        member[starts[b] // size : (starts[b] + counts[b] - 1) // size + 1, b] = True
    grid = np.stack(np.divmod(np.arange(BINS), 17), axis=1)
    close = np.abs(grid[:, None] - grid[None]).sum(axis=2) <= radius
    reach = member.astype(np.float32) @ close.astype(np.float32)

    # Inside a bin the place is a hash, so a bin of any weight spreads over its tiles.
    first, weight = F.array(*map(F.lit, starts.tolist())), F.array(*map(F.lit, np.maximum(counts, 1).tolist()))
    slot = _bin(F.col("print")) + 1
    place = F.element_at(first, slot) + F.pmod(F.xxhash64("print"), F.element_at(weight, slot))
    tiled = prints.groupBy(F.floor(place / size).cast("int").alias("tile")).agg(
        F.array_sort(F.collect_list("print")).alias("prints")
    )

    @F.udf("array<struct<one:int,other:int>>", useArrow=False)
    def pairs(tile):
        partners = np.flatnonzero(member.astype(np.float32) @ reach[tile]).tolist()
        return [(min(tile, p), max(tile, p)) for p in partners]

    dealt = tiled.select("tile", "prints", F.explode(pairs("tile")).alias("pair")).select("tile", "prints", "pair.*")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        arrays = [np.asarray(p, np.int64) for p in group["prints"]]
        links = link_tiles(arrays[0], arrays[1] if len(arrays) > 1 else None, radius)
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    ship(prints.sparkSession)
    width = max(1, min(tiles * (tiles + 1) // 2, 4096))
    return dealt.repartition(width, "one", "other").groupBy("one", "other").applyInPandas(compare, "a long, b long")


def near_groups(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text",
    row_col: str | None = None,
) -> DataFrame:
    """(id, print, component): the least id reachable over links of ``radius`` bits or fewer.
    ``row_col``, a long, is passed on in front."""
    prints = stored(fingerprints(docs, shingle, id_col, text_col, row_col), "simhash")
    distinct = stored(prints.groupBy("print").agg(F.min(id_col).alias("least")), "simhash")
    roots = components(stored(print_links(distinct, radius), "simhash"), "simhash")
    rooted = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "root", F.coalesce("root", "print")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.select("print", "root").join(least, "root").select("print", "component")
    row = [row_col] if row_col else []
    return prints.join(named, "print").select(*row, id_col, "print", "component")


def unique_documents(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents whose id is the least of their group, all columns. Rows that share an
    id, null included, but not the text are judged each by its own group."""
    own = docs.select(F.xxhash64(text_col).alias("kept_row"), docs[id_col].alias("kept_id"), docs[text_col].alias("kept_text"))
    groups = near_groups(own, shingle, radius, "kept_id", "kept_text", "kept_row")
    keep = groups.where(F.col("kept_id").eqNullSafe(F.col("component"))).select("kept_id", "kept_row").distinct()
    same = docs[id_col].eqNullSafe(keep["kept_id"]) & (F.xxhash64(docs[text_col]) == keep["kept_row"])
    return docs.join(keep, same, "left_semi")
