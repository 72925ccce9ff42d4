"""MinHash near-duplicates by an inverted join over signature coordinates.

One Arrow step gives every text its set of word shingles (as 64-bit hashes), a digest of
that set and ``COORDINATES`` minima. Texts of one set are one node from there on. Every node
is posted under its coordinate-value pairs, and collisions are counted with two prunings:

* skip: a posting list of length one yields no collision, so it is dropped, and a node left
  with fewer than ``MATCHES`` lists cannot reach the threshold and is skipped altogether;
* prefix: of its remaining pairs, rarest first, a node is posted under all but the last
  ``MATCHES - 1``. Two nodes that collide ``MATCHES`` times share one of these.

Nodes that share a posting are gathered into blocks (a crowded gathering is cut into tiles),
where their collisions are counted in full; pairs of ``MATCHES`` or more are confirmed on
the whole sets and leave the block as a spanning forest, never as all pairs.

With 64 coordinates and 42 matches a pair at the similarity of 0.85 is missed with a
probability of some 3 in 100,000, a closer one less often.

Defined results: a null, empty or blank text has an empty set (n_shingles 0) and is linked
with nothing; fewer words than a shingle form one shingle. Repeated rows are one node and so
one component. A null id takes part, but names a component only if nothing else can.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lendmart.llm.common import components, map_rows, ship, stored

SHINGLE = 3
SIMILAR_PERCENT = 85
COORDINATES = 64
MATCHES = 42
#: Nodes that one block compares with one another.
BLOCK = 1024
#: Distinct words whose hashes a task keeps.
WORDS_KEPT = 1 << 20

_U64 = np.uint64
_rng = np.random.default_rng(12)
_MASKS = _rng.integers(0, 2**64, COORDINATES, _U64)
_FACTORS = _rng.integers(0, 2**64, COORDINATES, _U64) | _U64(1)


class _WordHashes(dict):
    """Word -> 64-bit hash, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    return h ^ (h >> _U64(32))


def shingle_set(text: str | None, hashes: _WordHashes, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return np.empty(0, _U64)
    values = np.fromiter(map(hashes.__getitem__, words), _U64, len(words))
    width = min(size, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, _U64)
    for k in range(width):
        total = _mix(total * _U64(0x9E3779B97F4A7C15) + values[k : k + n])
    return np.unique(total)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of non-empty sets: one row a set, one column a coordinate."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat(((joined ^ _MASKS[k]) * _FACTORS[k]) >> _U64(32), starts)
    return out


def _node(members: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(members.tobytes(), digest_size=8).digest(), "little", signed=True)


def _prints(docs: DataFrame, size: int) -> DataFrame:
    """(doc, body, n, node, sig) per row of ``docs`` (doc, body, text); no node without words."""

    def make():
        hashes = _WordHashes()

        def work(ids, bodies, texts):
            sets = [shingle_set(t, hashes, size) for t in texts]
            full = [s for s in sets if len(s)]
            rows = iter(signatures(full).view(np.int32).tolist() if full else ())
            return [
                (i, b, len(s), _node(s), next(rows)) if len(s) else (i, b, 0, None, None)
                for i, b, s in zip(ids, bodies, sets)
            ]

        return work

    kind = docs.schema["doc"].dataType.simpleString()
    return map_rows(docs, ["doc", "body", "text"], make, f"doc {kind}, body long, n long, node long, sig array<int>")


def _postings(nodes: DataFrame, least: int) -> DataFrame:
    """(token, node): the prefix of every node that can still reach ``least`` collisions."""
    posted = nodes.select("node", F.posexplode("sig").alias("place", "value")).select(
        "node", F.xxhash64("place", "value").alias("token")
    )
    sizes = posted.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    lists = posted.join(sizes, "token").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("size", "token"))).alias("lists")
    )
    prefix = F.slice("lists", 1, F.size("lists") - (least - 1))
    return lists.where(F.size("lists") >= least).select("node", F.explode(prefix).alias("p")).select("p.token", "node")


def _confirmed(nodes: np.ndarray, sets: list[np.ndarray], sides: np.ndarray, percent: int, least: int) -> list:
    """Links that connect the nodes of one gathering as all its similar pairs would; with
    two ``sides``, pairs across them. Collisions are counted before sets are compared, and
    nodes that are connected already are not compared again."""
    sizes = np.array([len(s) for s in sets])
    prints = signatures(sets)
    cuts = np.cumsum([0, *sizes])
    shingles, places = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.zeros(len(shingles), np.int64)
    group = np.arange(len(nodes))
    two = sides.min() != sides.max()
    links = []
    for i in range(len(nodes) - 1):
        after = slice(i + 1, None)
        near = (group[after] != group[i]) & (np.count_nonzero(prints[after] == prints[i], axis=1) >= least)
        near &= 100 * np.minimum(sizes[after], sizes[i]) >= percent * np.maximum(sizes[after], sizes[i])
        if two:
            near &= sides[after] != sides[i]
        others = np.flatnonzero(near) + i + 1
        if not len(others):
            continue
        mine = places[cuts[i] : cuts[i + 1]]
        held[mine] = 1
        theirs = np.concatenate([places[cuts[j] : cuts[j + 1]] for j in others])
        common = np.add.reduceat(held[theirs], np.cumsum([0, *sizes[others[:-1]]]))
        held[mine] = 0
        for j in others[100 * common >= percent * (sizes[i] + sizes[others] - common)].tolist():
            if group[j] != group[i]:
                group[group == group[j]] = group[i]
                links.append((int(nodes[i]), int(nodes[j])))
    return links


def similar_links(sets: DataFrame, percent: int, least: int) -> DataFrame:
    """(a, b) from (node, root, members): links that connect what similar pairs of nodes of
    one root connect. Small roots share a task; a crowded one is cut into tiles, and every
    pair of its tiles meets in one group."""
    sizes = sets.groupBy("root").agg(F.count(F.lit(1)).alias("rows"))
    crowded = sizes.where(F.col("rows") > BLOCK).select("root", F.ceil(F.col("rows") / BLOCK).cast("int").alias("tiles"))
    total = sets.count()
    bins = max(1, total // BLOCK)
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    other = F.sequence(F.lit(0), F.col("tiles") - 1)
    marked = sets.join(crowded, "root", "left")  # one row in BLOCK at most; Spark sees its size
    few = marked.where("tiles IS NULL").select(
        F.pmod(F.xxhash64("root"), F.lit(bins)).alias("bin"), F.lit(-1).alias("one"), F.lit(-1).alias("two"),
        F.lit(0).alias("side"), "root", "node", "members",
    )
    many = marked.where("tiles IS NOT NULL").withColumn("tile", tile).select(
        F.col("root").alias("bin"), F.explode(other).alias("other"), "tile", "root", "node", "members"
    ).select(
        "bin", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"),
        (F.col("tile") > F.col("other")).cast("int").alias("side"), "root", "node", "members",
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(group: pa.Table) -> pa.Table:
        roots, nodes = np.asarray(group["root"]), np.asarray(group["node"])
        sides = np.asarray(group["side"])
        members = group["members"].combine_chunks()
        values, cuts = np.asarray(members.values).view(_U64), np.asarray(members.offsets)
        links = []
        order = np.lexsort((nodes, roots))
        order = order[np.append(True, nodes[order][1:] != nodes[order][:-1])]  # a node once
        for run in np.split(order, np.flatnonzero(np.diff(roots[order])) + 1):
            if len(run) > 1:
                own = [values[cuts[k] : cuts[k + 1]] for k in run]
                links += _confirmed(nodes[run], own, sides[run], percent, least)
        return pa.table([[a for a, _ in links], [b for _, b in links]], schema=schema)

    ship(sets.sparkSession)
    return few.unionAll(many).groupBy("bin", "one", "two").applyInArrow(compare, "a long, b long")


def near_sets(
    docs: DataFrame, percent: int = SIMILAR_PERCENT, least: int = MATCHES, size: int = SHINGLE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_shingles, component) per row of ``docs``: the size of its set and the least id
    that links of ``percent`` or more reach."""
    own = docs.select(
        docs[id_col].alias("doc"), F.xxhash64(docs[text_col]).alias("body"), docs[text_col].alias("text")
    )
    prints = stored(_prints(own, size), "minhash")
    nodes = stored(
        prints.where("node IS NOT NULL").groupBy("node").agg(
            F.min("doc").alias("least"), F.min(F.struct("doc", "body")).alias("row"), F.first("sig").alias("sig")
        ),
        "minhash",
    )
    postings = stored(_postings(nodes, least), "minhash")
    heads = postings.groupBy("token").agg(F.min("node").alias("head"))
    shared = postings.join(heads, "token").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    gathered = components(shared, "minhash")

    wanted = gathered.join(nodes, "node").select(F.col("node").alias("of"), "root", "row.doc", "row.body")
    texts = own.join(
        wanted, own["doc"].eqNullSafe(wanted["doc"]) & (own["body"] == wanted["body"])
    ).select("of", "root", "text")

    def make():
        hashes = _WordHashes()

        def work(of, roots, bodies):
            sets = [shingle_set(t, hashes, size) for t in bodies]
            return [(n, r, s.view(np.int64)) for n, r, s in zip(of, roots, sets) if _node(s) == n]

        return work

    sets = stored(
        map_rows(texts, ["of", "root", "text"], make, "node long, root long, members array<long>"), "minhash"
    )
    roots = components(stored(similar_links(sets, percent, least), "minhash"), "minhash")
    rooted = nodes.select("node", "least").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(names, "root").select("node", "component")
    return prints.join(named, "node", "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc")).otherwise(F.col("component")).alias("component"),
    )
