"""Periodic runs of words by enumeration of maximal pairs.

The words of a batch of documents become one array of numbers, told apart by document. Ranks
of the blocks of 1, 2, 4, ... words from each place give the order of the suffixes and, kept
for every size, the longest common prefix of neighbours; only places whose block occurs
again in their document go on to the next size, so plain prose costs a few vector steps.

The LCP intervals are then built bottom-up. An interval holds its places in text order, each
with its class, the word to its left. When a child joins an interval of prefix length l, a
place of the smaller side is paired with the places of the larger side within l words and of
another class: such a pair extends neither to the right (different children) nor to the left
(different classes), so it is a maximal pair, and a maximal pair at a distance d of l or
less is a whole run of l + d words with period d. Nothing is extended afterwards. A run is
met once for every multiple of its smallest period that fits; the smallest stays.

Classes need no list of their own to be told apart quickly: occurrences of one string of l
words within l places of each other step by its period, so all to the right of a place are of
one class, and of those to the left all but the first are of the place's own class. One
comparison on either side therefore decides, and no pair of equal classes is ever walked.

Defined results: a null, empty or blank text has no words and no runs, its collapsed text is
empty. Repeated rows and null ids give a row each. Texts are taken whole.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
from pyspark.sql import DataFrame

from lendmart.llm.common import map_rows

LEAST = 12
#: Words that a task's dictionary holds before it starts anew.
WORDS_KEPT = 1 << 20


class _Numbers(dict):
    """Word -> number, in the order of first occurrence."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _refined(rank: np.ndarray, places: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Splits the groups of equal ``rank`` among ``places`` by ``second``, in place; returns
    the places that are still in a group of several. A rank is the number of suffixes ahead."""
    key = rank[places] * (len(rank) + 1) + second
    order = np.argsort(key, kind="stable")
    key, places = key[order], places[order]
    old = rank[places]
    at = np.arange(len(places))
    begin = lambda change: np.maximum.accumulate(np.where(np.append(True, change), at, 0))
    group, part = begin(np.diff(old) != 0), begin(np.diff(key) != 0)
    rank[places] = old + part - group
    several = np.append(np.diff(part) == 0, False)
    several[1:] |= several[:-1]
    return places[several]


def repeats(words: np.ndarray, docs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, prefixes, left): places whose suffix shares ``least`` words or more with
    another of its document, in suffix order; the words each shares with the one before
    (0: another group); and the class of every place, -1 where a document begins."""
    n = len(words)
    rank = np.zeros(n, np.int64)
    _, rank[:] = np.unique(docs * (words.max() + 1) + words, return_inverse=True)
    order = np.argsort(rank, kind="stable")
    sizes = np.bincount(rank)
    rank = (np.cumsum(sizes) - sizes)[rank]  # suffixes ahead
    left = np.append(-1, rank[:-1])
    left[1:][docs[1:] != docs[:-1]] = -1
    again = np.append(np.diff(rank[order]) == 0, False)
    again[1:] |= again[:-1]
    places = order[again]
    levels = [rank.copy()]
    wide, kept = 1, None
    while len(places):
        ahead = places + wide
        inside = ahead < n
        inside[inside] = docs[ahead[inside]] == docs[places[inside]]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        places = _refined(rank, places, second)
        wide *= 2
        if 2 * wide > least and kept is None:
            kept = places  # the widest block not over the least length occurs again
        levels.append(rank.copy())
    if kept is None or not len(kept):
        return np.empty(0, np.int64), np.empty(0, np.int64), left
    kept = kept[np.argsort(rank[kept])]
    a, b = kept[:-1], kept[1:]
    shared = np.zeros(len(a), np.int64)
    for size in range(len(levels) - 1, -1, -1):
        level = np.append(levels[size], -1)
        x, y = np.minimum(a + shared, n), np.minimum(b + shared, n)
        shared += np.where((level[x] == level[y]) & (x < n) & (y < n), 1 << size, 0)
    shared[shared < least] = 0
    return kept, np.append(0, shared), left


def _merged(one: list[int], other: list[int]) -> list[int]:
    """Both lists of places in text order; ``one`` is the longer."""
    if len(other) * 16 < len(one):
        for place in other:
            insort(one, place)
        return one
    return sorted(one + other)


def _joined(one: list[int], other: list[int], length: int, left: list[int], least: int, runs: dict) -> list[int]:
    """Joins two children of an interval of prefix ``length`` and notes the runs that the
    maximal pairs between them are: (start, length) -> smallest period."""
    if len(one) < len(other):
        one, other = other, one

    def note(i: int, j: int) -> None:
        period = j - i
        if length + period >= least:
            key = (i, length + period)
            if period < runs.get(key, period + 1):
                runs[key] = period

    for place in other:
        own = left[place]
        k = bisect_right(one, place)
        while k < len(one) and one[k] - place <= length and left[one[k]] != own:
            note(place, one[k])
            k += 1
        k = bisect_left(one, place - length)
        if one[k : k + 1] and one[k] < place and left[one[k]] != own:
            note(one[k], place)
    return _merged(one, other)


def runs_of(words: np.ndarray, docs: np.ndarray, least: int = LEAST) -> dict[tuple[int, int], int]:
    """(start, length) -> period of all runs of ``least`` words or more; ``docs`` tells the
    document of each word, neighbours of one document stand together."""
    runs: dict[tuple[int, int], int] = {}
    if not len(words):
        return runs
    places, shared, left = repeats(words, docs, -(-least // 2))
    places, shared, left = places.tolist(), shared.tolist(), left.tolist()
    open_: list[tuple[int, list[int]]] = []  # intervals from the outermost in: (length, places)
    for k, place in enumerate(places):
        node = [place]
        follows = shared[k + 1] if k + 1 < len(places) else 0
        while open_ and open_[-1][0] >= max(follows, 1):
            length, rest = open_.pop()
            node = _joined(rest, node, length, left, least, runs)
            if length == follows:
                break
        if follows:
            open_.append((follows, node))
    return runs


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run (start, length, period) repeats, joined by single spaces."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs, collapsed) per row of ``docs``: its runs of ``least`` words or more by
    start and period, and its words without the repetitions. No shuffle.

    A run is a stretch of words that repeats its smallest period at least once in full and
    that neither neighbour continues.
    """

    def make():
        numbers = _Numbers()

        def work(ids, texts):
            nonlocal numbers
            if len(numbers) >= WORDS_KEPT:
                numbers = _Numbers()
            split = [(t or "").encode().split() for t in texts]  # bytes: only ASCII blanks split
            sizes = [len(w) for w in split]
            flat = np.fromiter((x for w in split for x in map(numbers.__getitem__, w)), np.int64, sum(sizes))
            firsts = np.cumsum([0, *sizes])
            found: list[list[tuple[int, int, int]]] = [[] for _ in split]
            for (start, length), period in runs_of(flat, np.repeat(np.arange(len(split)), sizes), least).items():
                doc = int(np.searchsorted(firsts, start, "right")) - 1
                found[doc].append((start - int(firsts[doc]), length, period))
            rows = []
            for i, words, runs in zip(ids, split, found):
                runs.sort(key=lambda r: (r[0], r[2]))
                spans = [{"start": s, "length": n, "period": p} for s, n, p in runs]
                rows.append((i, spans, collapsed(words, runs).decode()))
            return rows

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs, [id_col, text_col], make,
        f"`{id_col}` {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )
