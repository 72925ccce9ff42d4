"""Collocations, MinHash near-duplicates and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendmart.llm import minhash_near, period_runs, phrases, registry

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4),
    (4, "one two three four five six", "en", "a", 9), (4, "one two three four five six", "en", "a", 9),
    (None, "no id at all, but words enough to count as a line", None, "a", 1), (8, "two words", "en", "a", 1),
    (6, "long " * 30000 + "end\n" + "x" * 50000, "en", "a", 1), (9, "TWO Words", None, None, None),
    (7, "é🙂 <|endoftext|> Öl mit\x1cZeichen\u0085 ende", "de", "b", 1),
]
CLASHING = ("a.b", "node", "root", "token", "prefix", "slice", "entries", "runs", "collapsed", "doc", "body", "rank", "n")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with clashing names."""
    docs = spark.createDataFrame(ODD, SCHEMA)
    return docs.select("*", *[F.lit("extra").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return registry.table(spark, SF, "documents")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- 11 collocations --------------------------------------------------------------------
def plain_collocations(rows, top, least=30):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            found = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(found)
            for k in range(1, 5):
                for i in range(len(found) - k + 1):
                    counts[lang][tuple(found[i : i + k])] += 1
    out = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        gone = {
            p[i : i + k] for p, b in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if 100 * b >= 80 * candidates[p[i : i + k]]
        }
        ranked = []
        for p, a in candidates.items():
            if p not in gone:
                score, _, left, right = min(
                    (2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return out


def test_collocations_query(spark, docs):
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    got = registry.op11_collocations(spark, SF)
    assert dict(got.dtypes) == {c: "bigint" for c in ("a", "l", "r", "n", "score")} | {
        "lang": "string", "phrase": "string", "rank": "int"}
    want = plain_collocations(rows, 2000)
    assert len(want) > 20 and {tuple(r) for r in got.collect()} == want


def made_talk(seed, n):
    """Words of few kinds, so that phrases nest, repeat, overlap and tie."""
    rng = random.Random(seed)
    marks = [" "] * 12 + ["\t", "  ", ", ", "\n", ".", "\r\n", "! "]
    return [
        (rng.choice(["en", None, "und", "é"]),
         "".join(rng.choice(["a", "B", "b", "Öl", "öl", "c\x1cd", "e f"]) + rng.choice(marks) for _ in range(rng.randrange(60))))
        for _ in range(n)
    ]


@pytest.mark.parametrize("bits, octets", [(1 << 25, 1 << 23), (1 << 15, 200)])
def test_collocations_of_nested_phrases(spark, bits, octets):
    """Also with a crowded bit map and with stripes counted a few words at a time."""
    rows = made_talk(1, 200)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for top, least in ((2000, 30), (7, 12)):
        got = phrases.collocations(docs, top, least, filter_bits=bits, octets=octets)
        assert {tuple(r) for r in got.collect()} == plain_collocations(rows, top, least)


def test_words_and_codes(monkeypatch):
    """Blocks of any size give the same words, codes and pieces."""
    texts = [lower(t or "").encode() for _, t in made_talk(5, 60)] + [b"", b"x" * 300, b" \t.", b"aa ab a b"]
    whole = phrases.words_of(texts)
    plain = [
        (piece, word) for piece, part in enumerate(re.split(b"[.,;:!?\x0a-\x0d]", b"\n".join(texts)))
        for word in re.findall(b"[^\x20\x09]+", part)
    ]
    assert [(p, whole.text(k, k)) for k, p in enumerate(whole.pieces.tolist())] == plain
    code = {}
    for (_, word), value in zip(plain, whole.values.tolist(), strict=True):
        assert code.setdefault(word, value) == value
    assert len(set(code.values())) == len(code)
    for block in (1, 7, 64):
        monkeypatch.setattr(phrases, "BLOCK", block)
        cut = phrases.words_of(texts)
        assert all(np.array_equal(a, b) for a, b in zip(whole[1:], cut[1:], strict=True))


def test_heavy_stripes_are_cut_and_add_up():
    """Every entry of a stripe lies in one bucket, a heavy stripe's in several."""
    text = [b"the w%d\n" % (k % 700) for k in range(3000)]
    whole = Counter(tuple(t.split()) for t in text)
    code = phrases.phrase_codes(phrases.words_of(text[:1]).values, 1, "en")
    everything = np.full(1 << 12, 255, np.uint8).tobytes()
    for heavy, several in ((code[:1], True), (code[:0], False)):
        filter_ = phrases.Filter(everything, heavy, 64)
        merged = defaultdict(phrases._Merged)
        for part in (text[:200], text[200:], []):
            for bucket, packed in phrases.counted("en", phrases.words_of(part), 1, filter_):
                merged[bucket].add(packed)
        got, buckets = Counter(), set()
        for bucket, stripes in merged.items():
            for prefix, total, entries in stripes.finished(1):
                assert total == sum(n for _, n in entries)
                for word, count in entries:
                    assert (prefix, word) not in got
                    got[prefix, word] = count
                    buckets.add(bucket)
        assert got == whole and (len(buckets) > 30) == several


def test_exact_scores_of_large_counts(spark):
    big = 6_000_000_000_000_000
    levels = [
        spark.createDataFrame([("en", "a", 3 * big), ("en", "b", 7)], "lang string, phrase string, count long"),
        spark.createDataFrame([("en", "a b", big)], "lang string, phrase string, count long"),
    ]
    row = phrases._scored(levels).first()
    assert row["score"] == 2_000_000 * big // (3 * big + 7)


def test_collocation_odd_cases(odd, none):
    got = {tuple(r) for r in phrases.collocations(odd, 5).collect()}
    assert got == plain_collocations([(r[2], r[1]) for r in ODD], 5)
    assert phrases.collocations(none, 5).count() == 0


# --- 12 MinHash ---------------------------------------------------------------------------
def plain_sets(rows):
    out = []
    for _, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", lower(text))
        out.append({tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} - {()})
    return out


def plain_near(rows):
    """(id, n_shingles, least id reachable) of every row."""
    sets = plain_sets(rows)
    group = list(range(len(rows)))
    for i, one in enumerate(sets):
        for j in range(i):
            if one and sets[j] and 100 * len(one & sets[j]) >= 85 * len(one | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for (doc, _), g in zip(rows, group):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return sorted(((d, len(s), least.get(g)) for (d, _), s, g in zip(rows, sets, group)), key=str)


def near_copies(seed, bases, copies, words=60, changes=4):
    """Texts with copies that differ in some words, so similarities lie on both sides of 0.85."""
    rng = random.Random(seed)
    rows = []
    for b in range(bases):
        base = [f"w{rng.randrange(400)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(changes)):
                own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(own)))
    rng.shuffle(rows)
    return rows


def test_minhash_query(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = registry.op12_minhash_near_dedup(spark, SF).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == plain_near(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("block", [1024, 16])
def test_minhash_links_near_copies(spark, monkeypatch, block):
    """Also where a gathering is cut into tiles."""
    monkeypatch.setattr(minhash_near, "BLOCK", block)
    rows = near_copies(3, 6, 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in minhash_near.near_sets(docs).collect()]
    assert sorted(got, key=str) == plain_near(rows)
    assert len({c for _, _, c in got}) > 6


def test_minhash_misses_no_pair_at_the_threshold(spark):
    """Pairs of similarity 0.85 to 0.86, each alone: none is lost."""
    rows = []
    for pair in range(150):
        common = [f"p{pair}w{k}" for k in range(100)]
        ends = [f"p{pair}x{k}" for k in range(17)]
        one, other = common + ends[:8], common + ends[8:]  # 98 shingles of 115 are common
        rows += [(2 * pair, " ".join(one)), (2 * pair + 1, " ".join(other))]
    sets = plain_sets(rows[:2])
    assert 100 * len(sets[0] & sets[1]) >= 85 * len(sets[0] | sets[1]) > 98 * len(sets[0] & sets[1])
    got = dict(minhash_near.near_sets(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component").collect())
    assert got == {i: i // 2 * 2 for i in range(300)}


def test_minhash_sets_of_rows_that_share_an_id(spark):
    rows = [(5, "a b c d"), (5, "e f g h"), (3, "e f g h"), (None, "a b c d"), (None, "q r s"), (None, None), (7, "A b  c\td")]
    got = minhash_near.near_sets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(5, 2, 5), (5, 2, 3), (3, 2, 3), (None, 2, 5), (None, 1, None), (None, 0, None), (7, 2, 5)], key=str)


def test_minhash_odd_cases(odd, none):
    got = sorted(map(tuple, minhash_near.near_sets(odd).collect()), key=str)
    assert got == plain_near([(r[0], r[1]) for r in ODD])
    by_id = {g[0]: g[2] for g in got}
    assert by_id[1] == 1 and by_id[2] == 2 and by_id[3] == 3 and by_id[9] == by_id[8] == 8
    assert minhash_near.near_sets(none).count() == 0


# --- 13 periodic runs ---------------------------------------------------------------------
def plain_runs(words, least=12):
    out = []
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i : j + q]
            if length >= max(least, 2 * q) and not any(part[r:] == part[: length - r] for r in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    if doc is not None and n and (h := zlib.crc32(str(doc).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {k for s, length, p in runs for k in range(s + p, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
        sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)),
    )


def test_runs_query(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if len(r["text"] or "") < 30000]
    want = {r[0]: r for r in (plain_row(*x) for x in rows)}
    got = {r["doc_id"]: tuple(r) for r in registry.op13_period_runs(spark, SF).collect()}
    assert len(got) == docs.count() and sum(r[1] > 0 for r in want.values()) > 10
    assert {d: got[d] for d in want} == want


def test_runs_of_crowded_words():
    rng = random.Random(6)
    for _ in range(600):
        texts = []
        for _ in range(rng.randint(1, 4)):
            n, kind = rng.randint(0, 60), rng.random()
            base = [rng.randint(0, 2) for _ in range(rng.randint(1, 12))]
            words = [rng.randint(0, 1) for _ in range(n)] if kind < 0.4 else [base[i % len(base)] for i in range(n)]
            for _ in range(rng.randint(0, 2) if n else 0):
                words[rng.randrange(n)] = rng.randint(0, 3)
            texts.append(words)
        least = rng.choice([4, 5, 6, 12])
        flat = np.array([w for t in texts for w in t], np.int64)
        got = period_runs.runs_of(flat, np.repeat(np.arange(len(texts)), list(map(len, texts))), least)
        want, start = {}, 0
        for t in texts:
            want |= {(start + s, length): p for s, length, p in plain_runs(t, least)}
            start += len(t)
        assert got == want


def test_runs_of_long_texts_stay_cheap():
    """One word a hundred thousand times, and a line repeated with other words around it."""
    one = np.zeros(100_000, np.int64)
    assert period_runs.runs_of(one, one) == {(0, 100_000): 1}
    lines = np.array([w for k in range(4000) for w in (k + 100, *range(20), 90_000 + k % 7)], np.int64)
    assert period_runs.runs_of(lines, np.zeros_like(lines)) == {}


def test_runs_odd_cases(spark, odd, none):
    got = {(r[0], tuple(map(tuple, r[1])), r[2]) for r in period_runs.periodic_runs(odd).collect()}
    want = set()
    for doc, text, *_ in ODD:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        runs = [(0, 30000, 1)] if doc == 6 else plain_runs(words)
        want.add((doc, tuple(runs), "long end " + "x" * 50000 if doc == 6 else " ".join(words)))
    assert got == want and period_runs.periodic_runs(odd).count() == len(ODD)
    assert period_runs.periodic_runs(none).count() == 0
    planted = registry.planted_periods(odd.select("doc_id", "text")).collect()
    assert len(planted) == len(ODD) and planted[0]["text"] is None
