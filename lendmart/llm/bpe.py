"""Byte-level BPE by speculation: greedy longest match, vectorised checks, exact repair.

A word's tokens are right exactly if every adjacent pair is compatible, that is, if merging
the bytes of the two tokens alone gives the two tokens back. Merges happen in order of rank,
so each token on the facing edges of a pair exists from its own merge until its parent's;
the pair breaks if some merge across the border comes while both of its parts exist (at
equal rank the left one comes first). Words with an incompatible pair, or with a token that
its own bytes do not merge to, are merged exactly.

Defined results: a null text counts as empty and has no ids. Special tokens in a text are
matched as the tokenizer file says. Rows are treated one by one.
"""

from __future__ import annotations

import heapq
import json
import struct
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from lendmart.llm.common import map_rows

# Fixed value: how a byte-level tokenizer splits text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = np.int64(1) << 40
_NONE = int(NEVER)
# Stands between words whose bytes are written as characters up to 255.
_BREAK = "\uffff"
#: Words kept with their ids in a worker, twice over: a full table becomes the old one, from
#: which words come back when they are met again.
MAX_KNOWN = 400_000
LONG_WORD = 128
#: Characters of texts that are split into words at a time (one text at least).
GROUP_CHARS = 1_000_000


def _byte_chars() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others
    counted up from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars, free = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in chars:
            chars[b] = chr(free)
            free += 1
    return [chars[b] for b in range(256)]


class Bpe:
    """Tables of one tokenizer file, and the words met so far."""

    def __init__(self, path: str):
        data = json.loads(Path(path).read_text(encoding="utf-8"))
        model, chars = data["model"], _byte_chars()
        byte_of = {c: b for b, c in enumerate(chars)}
        as_bytes = lambda token: bytes(byte_of[c] for c in token)
        self.ids = {as_bytes(t): i for t, i in model["vocab"].items()}
        self.specials = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.size = max([*self.ids.values(), *self.specials.values()]) + 1
        self.bytes_of = [b""] * self.size
        for token, i in self.ids.items():
            self.bytes_of[i] = token
        for content, i in self.specials.items():
            self.bytes_of[i] = content.encode()
        self.longest = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.longest.add_word(token.decode("latin-1"), i)
        self.longest.make_automaton()
        self.of_byte = [self.ids[bytes((b,))] for b in range(256)]

        n = len(model["merges"])
        pairs = np.empty((n, 2), np.int64)
        made = np.empty(n, np.int64)
        for k, merge in enumerate(model["merges"]):
            a, b = (as_bytes(t) for t in (merge.split(" ") if isinstance(merge, str) else merge))
            pairs[k], made[k] = (self.ids[a], self.ids[b]), self.ids[a + b]
        keys = pairs[:, 0] * self.size + pairs[:, 1]
        self.rank_of = dict(zip(keys.tolist(), range(n)))
        self.made = made.tolist()
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.birth = np.full(self.size + 1, -1, np.int64)  # the last row stands for "no token"
        self.left, self.right = (np.full(self.size + 1, self.size, np.int64) for _ in range(2))
        self.birth[made] = np.arange(n)
        self.left[made], self.right[made] = pairs[:, 0], pairs[:, 1]
        # Tokens that their own bytes do not merge to, or that several merges make.
        self.odd = np.zeros(self.size, bool)
        self.odd[made] = ~self.compatible(pairs[:, 0], pairs[:, 1], np.arange(n))
        twice, times = np.unique(made, return_counts=True)
        self.odd[twice[times > 1]] = True
        for m, (a, b) in zip(made.tolist(), pairs.tolist()):
            self.odd[m] |= self.odd[a] or self.odd[b]
        self.split = regex.compile(WORDS).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (a < self.size) & (b < self.size)
        return np.where(hit, self.order[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, end: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge before rank ``end`` crosses the border between ``a`` and ``b``."""
        end = np.full(len(a), NEVER - 1) if end is None else end
        good = np.ones(len(a), bool)
        rows, x, until_x = np.arange(len(a)), a, end
        while len(rows):
            inner, y, until_y, own = rows, b[rows], end[rows], np.arange(len(rows))
            while len(inner):
                rank = self.ranks(x[own], y)
                good[inner[(rank < until_x[own]) & (rank <= until_y)]] = False
                until_y, y = self.birth[y], self.left[y]
                go = y < self.size
                inner, y, until_y, own = inner[go], y[go], until_y[go], own[go]
            until_x, x = self.birth[x], self.right[x]
            go = x < self.size
            rows, x, until_x = rows[go], x[go], until_x[go]
        return good

    def greedy(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Leftmost longest matches of all words at once: the tokens, and whose they are."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        line = _BREAK.join(word.decode("latin-1") for word in words)
        found = list(self.longest.iter_long(line))
        ends = np.fromiter((end for end, _ in found), np.int64, len(found))
        tokens = np.fromiter((token for _, token in found), np.int64, len(found))
        return tokens, np.searchsorted(np.cumsum(sizes), ends, side="right")

    def exact(self, word: bytes) -> list[int]:
        """Merges by rank, leftmost first."""
        if len(word) > LONG_WORD:
            return self._exact_queued(word)
        rank_of, size, made = self.rank_of.get, self.size, self.made
        tokens = [self.of_byte[b] for b in word]
        ranks = [rank_of(a * size + b, _NONE) for a, b in zip(tokens, tokens[1:])]
        while ranks and (best := min(ranks)) != _NONE:
            i = ranks.index(best)
            tokens[i : i + 2] = (new := made[best],)
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of(tokens[i - 1] * size + new, _NONE)
            if i < len(ranks):
                ranks[i] = rank_of(new * size + tokens[i + 1], _NONE)
        return tokens

    def _exact_queued(self, word: bytes) -> list[int]:
        """The same with a queue: n log n for a word of n bytes."""
        rank_of, size = self.rank_of.get, self.size
        tokens = [self.of_byte[b] for b in word]
        n = len(tokens)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        pairs = enumerate(zip(tokens, tokens[1:]))
        queue = [(r, i, a, b) for i, (a, b) in pairs if (r := rank_of(a * size + b, _NONE)) != _NONE]
        heapq.heapify(queue)
        while queue:
            rank, i, a, b = heapq.heappop(queue)
            j = after[i]
            if tokens[i] != a or j < 0 or tokens[j] != b:
                continue
            tokens[i], tokens[j] = self.made[rank], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0:
                    a, b = tokens[k], tokens[after[k]]
                    if (rank := rank_of(a * size + b, _NONE)) != _NONE:
                        heapq.heappush(queue, (rank, k, a, b))
        return [t for t in tokens if t >= 0]

    def learn(self, words: list[str]) -> None:
        """Ids of words not met before."""
        raw = [w.encode() for w in words]
        flat, owner = self.greedy(raw)
        packed = flat.astype("<u4").tobytes()
        starts = (4 * np.searchsorted(owner, np.arange(len(raw) + 1))).tolist()
        bad = np.zeros(len(raw), bool)
        bad[owner[self.odd[flat]]] = True
        inside = owner[1:] == owner[:-1]
        keys = (flat[:-1] * self.size + flat[1:])[inside]
        unique, place = np.unique(keys, return_inverse=True)
        new = [k for k in unique.tolist() if k not in self.pairs]
        if new:
            if len(self.pairs) > MAX_KNOWN:
                self.pairs.clear()
                new = unique.tolist()
            a, b = np.divmod(np.array(new, np.int64), self.size)
            self.pairs.update(zip(new, self.compatible(a, b).tolist()))
        verdict = np.fromiter((self.pairs[k] for k in unique.tolist()), bool, len(unique))
        bad[owner[1:][inside][~verdict[place]]] = True
        for word, own, wrong, start, stop in zip(words, raw, bad.tolist(), starts, starts[1:]):
            if wrong:
                ids = self.exact(own)
                self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                self.known[word] = packed[start:stop]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out, group, chars = [], [], 0
        for text in texts:
            group.append(text or "")
            chars += len(group[-1])
            if chars >= GROUP_CHARS:
                out += self._group(group)
                group, chars = [], 0
        return out + self._group(group)

    def _group(self, texts: list[str]) -> list[bytes]:
        split = []
        for text in texts:
            if any(s in text for s in self.specials):
                parts = self.special.split(text)
                split.append([w for p in parts for w in ([p] if p in self.specials else self.split(p))])
            else:
                split.append(self.split(text))
        distinct = set().union(*split)
        if len(self.known) > MAX_KNOWN:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        known.update((s, struct.pack("<I", i)) for s, i in self.specials.items())
        missing = [w for w in distinct if w not in known]
        known.update((w, old[w]) for w in missing if w in old)
        self.learn(new := [w for w in missing if w not in old])
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        if len(distinct) > MAX_KNOWN:  # one text of very many words
            self.old, self.known = {}, {}
        for w in new:
            if len(w) > LONG_WORD:
                self.known.pop(w, None)
        return out

    def decode(self, ids: bytes) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Bpe:
    """The tables of a file, made once in each worker."""
    return Bpe(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) per row: ids as little-endian unsigned 32-bit integers, and the
    text that they decode to. ``path``: the tokenizer's file on every executor."""

    def make():
        bpe = tokenizer(path)

        def work(keys, texts):
            return [(k, ids, bpe.decode(ids)) for k, ids in zip(keys, bpe.encode(texts))]

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs, [id_col, text_col], make, f"`{id_col}` {kind}, ids binary, decoded string")
