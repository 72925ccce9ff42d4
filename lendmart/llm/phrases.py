"""Phrase collocations by stripes.

A stripe is the counter of the words that follow one prefix: of no word (so a stripe of all
words), one, two or three. Tasks count stripes over their documents, pack them by bucket of
the prefix, and the stripes of a bucket are merged elementwise after one shuffle. The stripe
of no word, and those of prefixes that hold over a thousandth of all words, lie in many
buckets, by their next words; buckets grow in number with the words, so none grows in size.
The merged stripes give everything at once: an entry is the count of a phrase (its prefix
and the next word), the sum of the empty prefix's stripe the number of words, an entry of a
shorter prefix the count of a part, and the largest entries of a phrase's own stripe and of
the stripes that end in it the counts of the longer phrases that may subsume it.

Stripes are made prefix length by prefix length. A phrase can only reach the least count if
the phrases without its first and without its last word do, so a stripe counts only words
that pass a bit map of the phrases found before. The bit map has a fixed size
(``FILTER_BITS``, 4 MB); where it is crowded more is counted, and the result is the same.

Of longer phrases that hold a phrase, one word more is enough: what a phrase two words
longer subsumes, the phrase between them subsumes as well.

Defined results: null, empty or blank texts have no words; a null language counts as
``und``. Repeated rows count each time. An empty table gives no rows. Scores are exact
(decimals), ties go by count, then by the phrase's bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from lendmart.llm.common import ship, stored

LONGEST = 4
LEAST = 30
SUBSUMES_PERCENT = 80
SCALE = 2_000_000
NO_LANG = "und"
#: A prefix is heavy if it holds more than one in so many words; so many can be.
HEAVY = 1024
#: Slices of a heavy prefix's stripe, by a hash of the next word.
SLICES = 256
#: Words that fall into one bucket on average, and buckets of the first level for each
#: shuffle partition; ``LEAST_BUCKETS`` at any rate.
BUCKET_WORDS = 1 << 21
FIRST_BUCKETS = 4
LEAST_BUCKETS = 256
#: Bits of the map of phrases that may be extended (a power of two, 2**15 at least).
FILTER_BITS = 1 << 25
#: Bytes of text that a task counts in one go.
OCTETS = 1 << 22
#: Pieces a language's phrases are ranked in before the last ranking.
RANK_PIECES = 64

_U64 = np.uint64
_FACTOR = 0x9E3779B97F4A7C15
_BREAK = b"\n"
# A-Z to lower case, every mark that ends a piece to a line feed, a tab to a space.
_PLAIN = bytearray(range(256))
_PLAIN[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
for _mark in b".,;:!?\n\v\f\r":
    _PLAIN[_mark] = ord(_BREAK)
_PLAIN[ord("\t")] = ord(" ")
_PLAIN = bytes(_PLAIN)

STRIPES = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("stripes", pa.binary())])


class Words(NamedTuple):
    """The words of a text: where they start and end, a code of each, and its piece."""

    plain: bytes
    starts: np.ndarray
    ends: np.ndarray
    values: np.ndarray
    pieces: np.ndarray

    def text(self, first: int, last: int) -> bytes:
        """The words from ``first`` to ``last``, joined by single spaces."""
        if first == last:
            return self.plain[self.starts[first] : self.ends[first]]
        return b" ".join([self.plain[self.starts[k] : self.ends[k]] for k in range(first, last + 1)])


# A word's code is a polynomial of its bytes, so the codes of a block come from running sums.
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes whose words are coded in one go; a longer word is taken whole.
BLOCK = 1 << 20


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, _U64)
    powers[0] = 1
    return np.cumprod(powers, dtype=_U64)


def _coded(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, values, breaks before) of the words of a block."""
    octets = np.frombuffer(block, np.uint8)
    inside = (octets != 32) & (octets != 10)
    edges = np.diff(inside, prepend=False, append=False)
    starts, ends = np.flatnonzero(edges).reshape(-1, 2).T
    size = 1 << max(10, len(block).bit_length())
    sums = np.zeros(len(block) + 1, _U64)
    np.cumsum((octets.astype(_U64) + _U64(1)) * _powers(_BASE, size)[: len(block)], out=sums[1:])
    values = (sums[ends] - sums[starts]) * _powers(_INVERSE, size)[starts]
    return starts, ends, _mix(values + (ends - starts).astype(_U64) * _U64(_FACTOR)), np.cumsum(octets == 10)[starts]


def words_of(texts: list[bytes]) -> Words:
    """The words of texts in UTF-8; a piece never goes on in the next text."""
    plain = _BREAK.join(texts).translate(_PLAIN)
    parts, start, pieces = [], 0, 0
    while start < len(plain):
        stop = start + BLOCK
        if stop < len(plain):  # the next blank or break
            ends = [k for k in (plain.find(b" ", stop), plain.find(_BREAK, stop)) if k >= 0]
            stop = min(ends, default=len(plain) - 1) + 1
        block = plain[start:stop]
        first, last, values, breaks = _coded(block)
        parts.append((first + start, last + start, values, breaks + pieces))
        pieces += block.count(_BREAK)
        start = stop
    columns = zip(*parts) if parts else [[np.empty(0, t)] for t in (np.int64, np.int64, _U64, np.int64)]
    return Words(plain, *map(np.concatenate, columns))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    return h ^ (h >> _U64(32))


def _extended(codes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Codes of phrases with one word more."""
    return _mix(codes * _U64(_FACTOR) + values)


def phrase_codes(values: np.ndarray, length: int, lang: str) -> np.ndarray:
    """Codes of the phrases of ``length`` words that start at each word."""
    n = max(0, len(values) - length + 1)
    total = np.full(n, xxhash.xxh3_64_intdigest(lang.encode()), _U64)
    for k in range(length):
        total = _extended(total, values[k : k + n])
    return total


def _starts(words: Words, length: int, lang: str, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a prefix of ``length`` words and a next word stand in one piece, and both the
    prefix and the phrase that ends in the next word are known; and the prefixes' codes."""
    front = phrase_codes(words.values, length, lang)
    if length == 0:
        return np.arange(len(words.values)), front[:-1]
    place = front & _U64(8 * len(known) - 1)
    found = known[place >> _U64(3)] >> (place & _U64(7)).astype(np.uint8) & 1 == 1
    starts = np.flatnonzero(found[:-1] & found[1:] & (words.pieces[length:] == words.pieces[:-length]))
    return starts, front[starts]


def _entry(word: bytes, count: int) -> bytes:
    return word if count == 1 else b"%s:%d" % (word, count)  # no word holds a colon


class Filter(NamedTuple):
    """What tasks know of the level before: a bit map of its phrases' codes, the codes of
    the phrases that hold a large part of all words, and the buckets to deal into."""

    known: bytes
    heavy: np.ndarray
    buckets: int


def counted(lang: str, words: Words, length: int, filter_: Filter) -> Iterator[tuple[int, bytes]]:
    """The stripes of some words, packed by bucket: a line a stripe, its prefix and its
    entries apart by tabs, an entry's count behind a colon unless it is one."""
    starts, front = _starts(words, length, lang, np.frombuffer(filter_.known, np.uint8))
    if not len(starts):
        return
    last = words.values[starts + length]
    _, first, counts = np.unique(_extended(front, last), return_index=True, return_counts=True)
    starts, front, last = starts[first], front[first], last[first]
    # The stripes of no word and of a heavy prefix are cut by next words, others stay whole.
    cut = _extended(front, last if length == 0 else last % _U64(SLICES))
    dealt = cut if length == 0 else np.where(np.isin(front, filter_.heavy), cut, front)
    bucket = dealt % _U64(filter_.buckets)
    order = np.lexsort((front, bucket))
    starts, front, bucket = starts[order], front[order], bucket[order]
    plain, at = words.plain, starts + length
    spans = zip(words.starts[at].tolist(), words.ends[at].tolist(), counts[order].tolist())
    entries = [_entry(plain[low:high], n) for low, high, n in spans]
    cuts = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (front[1:] != front[:-1]))).tolist()
    heads, buckets = starts[cuts].tolist(), bucket[cuts].tolist()
    lines: list[bytes] = []
    for k, (low, high) in enumerate(zip(cuts, [*cuts[1:], len(starts)])):
        prefix = words.text(heads[k], heads[k] + length - 1) if length else b""
        lines.append(b"\t".join([prefix, *entries[low:high]]))
        if k + 1 == len(cuts) or buckets[k + 1] != buckets[k]:
            yield buckets[k], b"\n".join(lines)
            lines = []


def partial_stripes(texts: DataFrame, length: int, filter_, octets: int = OCTETS) -> DataFrame:
    """Stripes of prefixes of ``length`` words over (lang, text), counted ``octets`` of text
    at a time; ``filter_`` is a broadcast ``Filter``."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            for lang, some in waiting.items():
                rows = list(counted(lang, words_of(some), length, filter_.value))
                if rows:
                    buckets, stripes = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(rows)), pa.array(buckets, pa.int64()), pa.array(stripes, pa.binary())],
                        schema=STRIPES)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if text.is_valid:
                    waiting.setdefault(lang, []).append(text.as_py())
                    held += len(waiting[lang][-1])
                if held >= octets:  # languages that are many share the bound
                    yield from packed()
                    waiting, held = {}, 0
        yield from packed()

    return texts.mapInArrow(step, "lang string, bucket long, stripes binary")


class _Merged:
    """The stripes of one bucket, merged elementwise."""

    def __init__(self) -> None:
        self.stripes: dict[bytes, Counter] = {}

    def add(self, packed: bytes) -> None:
        for line in packed.split(b"\n"):
            prefix, *entries = line.split(b"\t")
            stripe = self.stripes.get(prefix)
            if stripe is None:
                stripe = self.stripes[prefix] = Counter()
            stripe.update(entries)

    def finished(self, least: int) -> Iterator[tuple[bytes, int, list[tuple[bytes, int]]]]:
        """(prefix, total, entries of ``least`` and more) of every stripe."""
        for prefix, stripe in self.stripes.items():
            for entry in [e for e in stripe if b":" in e]:
                word, count = entry.split(b":")
                stripe[word] += int(count) * stripe.pop(entry)
            yield prefix, sum(stripe.values()), [(w, n) for w, n in stripe.items() if n >= least]


def merged_stripes(stripes: DataFrame, least: int) -> DataFrame:
    """(lang, prefix, total, entries): stripes merged elementwise, bucket by bucket; the
    total is over all words of the part of a stripe that lies in the bucket, its entries
    (word, count, code) reach ``least``. Of a prefix only parts with entries are passed on,
    of the empty prefix all."""
    kind = pa.list_(pa.struct([("word", pa.string()), ("count", pa.int64()), ("code", pa.int64())]))
    schema = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("total", pa.int64()), ("entries", kind)])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, merged = None, _Merged()

        def closed() -> Iterator[pa.RecordBatch]:
            lang, found = key and key[0], [s for s in merged.finished(least) if s[2] or not s[0]]
            if not found:
                return
            phrases = [prefix + b" " * (prefix != b"") + word for prefix, _, some in found for word, _ in some]
            words = words_of([_BREAK.join(phrases)])
            length = found[0][0].count(b" ") + 1 + (found[0][0] != b"")  # the same of all
            codes = iter(phrase_codes(words.values, length, lang)[::length].view(np.int64).tolist())
            rows = [
                (lang, prefix.decode(), total, [{"word": w.decode(), "count": n, "code": next(codes)} for w, n in some])
                for prefix, total, some in found
            ]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            for lang, bucket, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if (lang, bucket) != key:
                    yield from closed()
                    key, merged = (lang, bucket), _Merged()
                merged.add(packed)
        yield from closed()

    keys = ["lang", "bucket"]
    dealt = stripes.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(
        step, "lang string, prefix string, total long, entries array<struct<word:string,count:long,code:long>>"
    )


def _filter(entries: DataFrame, words: int, bits: int) -> Filter:
    """The filter for the level after ``entries``, ``bits`` bits and 1,024 codes at most
    whatever their number."""
    place = F.col("code").bitwiseAND(F.lit(bits - 1)) + 1
    found = entries.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    whole = bytearray(bits // 8)
    for bucket, part in found.collect():  # 4,096 bytes a bucket, all of them no more than ``bits``
        start = (bucket - 1) * len(part)
        whole[start : start + len(part)] = part
    heavy = entries.where(F.col("count") * HEAVY > words).select("code").collect()  # HEAVY at most
    return Filter(bytes(whole), np.array([r["code"] for r in heavy], np.int64).view(_U64), _buckets(words))


def _buckets(words: int) -> int:
    return max(LEAST_BUCKETS, words // BUCKET_WORDS)


def collocations(
    docs: DataFrame, top: int, least: int = LEAST, percent: int = SUBSUMES_PERCENT, longest: int = LONGEST,
    lang_col: str = "lang", text_col: str = "text", filter_bits: int = FILTER_BITS, octets: int = OCTETS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two to
    ``longest`` words that occur ``least`` times and are not subsumed.

    A phrase's score is the lowest of its cuts into two parts, ``SCALE`` times its count by
    the sum of the parts' counts, rounded down. A phrase goes if a longer one that holds it
    has ``percent`` of its count.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit(NO_LANG)).alias("lang"), docs[text_col].cast("binary").alias("text"))
    share = docs.sparkSession.sparkContext.broadcast
    width = FIRST_BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    levels, filter_ = [], Filter(b"", np.empty(0, _U64), max(LEAST_BUCKETS, width))
    for length in range(longest):
        partial = partial_stripes(texts, length, share(filter_), octets)
        merged = stored(merged_stripes(partial, least), "stripes")
        phrase = F.when(F.col("prefix") == "", F.col("e.word")).otherwise(F.concat_ws(" ", "prefix", "e.word"))
        entries = merged.select("lang", "prefix", F.explode("entries").alias("e")).select(
            "lang", "prefix", phrase.alias("phrase"), F.col("e.count").alias("count"), F.col("e.code").alias("code")
        )
        if length == 0:
            words = merged.groupBy("lang").agg(F.sum("total").alias("n"))
            in_all = words.agg(F.sum("n")).first()[0] or 0
        levels.append(entries)
        if length < longest - 1:
            filter_ = _filter(entries, in_all, filter_bits)
    return _ranked(_scored(levels), _subsuming(levels), words, top, percent)


def _scored(levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase, a, score, l, r): phrases of two words or more with their lowest cut."""
    parts = levels[0].select("lang", "phrase", "count")
    found = levels[1].select("lang", "phrase", "count")
    for level in levels[1:-1]:
        parts = parts.unionAll(level.select("lang", "phrase", "count"))
    for level in levels[2:]:
        found = found.unionAll(level.select("lang", "phrase", "count"))
    words = F.split("phrase", " ")
    cuts = found.select("lang", "phrase", F.col("count").alias("a"), F.explode(
        F.sequence(F.lit(1), F.size(words) - 1)
    ).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(words, 1, F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.size(words)), " ").alias("rest"),
    )
    first = parts.select("lang", F.col("phrase").alias("first"), F.col("count").alias("l"))
    rest = parts.select("lang", F.col("phrase").alias("rest"), F.col("count").alias("r"))
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(19,0))) DIV CAST(l + r AS DECIMAL(19,0))")
    return (
        cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    )


def _subsuming(levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase, longer): the largest count of a phrase with one word more at an end."""
    both = None
    for level in levels[2:]:
        without_first = F.regexp_replace("phrase", "^[^ ]* ", "")
        ends = level.select("lang", F.explode(F.array("prefix", without_first)).alias("phrase"), "count")
        both = ends if both is None else both.unionAll(ends)
    return both.groupBy("lang", "phrase").agg(F.max("count").alias("longer"))


def _ranked(scored: DataFrame, subsuming: DataFrame, words: DataFrame, top: int, percent: int) -> DataFrame:
    kept = scored.join(subsuming, ["lang", "phrase"], "left").where(
        f"longer IS NULL OR CAST(100 AS DECIMAL(10,0)) * longer < CAST({percent} AS DECIMAL(10,0)) * a"
    ).drop("longer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    piece = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PIECES))
    first = F.row_number().over(Window.partitionBy("lang", piece).orderBy(*order))
    last = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    best = kept.withColumn("rank", first).where(F.col("rank") <= top).withColumn("rank", last)
    return best.where(F.col("rank") <= top).join(words, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
