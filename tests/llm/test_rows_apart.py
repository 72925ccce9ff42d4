"""Rows that share an id or have none, extreme vectors and long keys: nothing is lost."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lendmart.llm import ann, chat_quotes, line_dedup, pseudonyms, warc_revisits


def test_records_that_share_an_id_or_have_none(spark):
    rows = [
        (None, "http://a.com/x", "response", 200, {"etag": "1"}, "whole", 1), (5, "http://a.com/x", "revisit", 304, {"etag": "1"}, None, 2),
        (7, "http://b.com/y", "response", 200, {"etag": "2"}, "other", 1), (5, "http://b.com/y", "revisit", 304, {"etag": "2"}, None, 2),
        (None, "http://b.com/y", "revisit", 304, {"etag": "3"}, None, 3), (None, "http://b.com/y", "revisit", 304, {"etag": "3"}, None, 3),
    ]
    frame = spark.createDataFrame(
        rows, "record_id long, url string, kind string, status int, headers map<string,string>, payload string, hour int"
    ).withColumn("captured_at", F.timestamp_seconds(F.lit(1735689600) + F.col("hour") * 3600))
    got = [(r["record_id"], r["url_key"], r["verdict"], r["ref_id"], r["payload"]) for r in warc_revisits.resolve_revisits(frame).collect()]
    assert sorted(got, key=str) == sorted([
        (5, "a.com/x", "resolved", None, "whole"), (5, "b.com/y", "resolved", 7, "other"),
        (None, "b.com/y", "changed", 7, None), (None, "b.com/y", "changed", 7, None)], key=str)


def test_messages_that_share_an_id_or_have_none(spark):
    rows = [
        (1, 1, "a", "tea time today my friends"), (1, 1, "b", "another text of that id"), (1, None, "c", "no id at all here"),
        (1, None, "d", "> tea time today my friends\nyes"), (1, 2, "e", "> no id at all here\nwhy"),
        (1, 3, "f", "> another text of that id\nthere"), (None, 4, "g", "no conversation"), (None, None, None, None),
    ]
    got = chat_quotes.conversations(spark.createDataFrame(rows, "conv_id long, msg_id long, role string, text string")).collect()
    assert sorted(((r["role"], r["parent"], r["depth"], r["text"]) for r in got), key=str) == sorted([
        ("a", None, 0, "tea time today my friends"), ("b", None, 0, "another text of that id"), ("c", None, 0, "no id at all here"),
        ("d", 1, 1, "yes"), ("e", None, 0, "why"), ("f", 1, 1, "there"), ("g", None, 0, "no conversation"), (None, None, 0, "")], key=str)


@pytest.mark.parametrize("block, group", [(8192, 128), (16, 4)])
def test_extreme_vectors_and_several_blocks(spark, monkeypatch, block, group):
    """Scores in exact fractions of the given components; also over many blocks and groups."""
    from fractions import Fraction
    from math import isqrt

    monkeypatch.setattr(ann, "BLOCK_ROWS", block)
    monkeypatch.setattr(ann, "GROUP_QUERIES", group)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(4) * 10.0 ** (0 if i % 3 else rng.choice([-200, 200]))).tolist()) for i in range(120)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(frame, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))

    def cosine(a, b):
        dot = lambda x, y: sum((p * q for p, q in zip(x, y)), Fraction(0))
        a, b = [Fraction(x) for x in a], [Fraction(x) for x in b]
        square = dot(a, b) ** 2 / (dot(a, a) * dot(b, b))
        return (1 if dot(a, b) >= 0 else -1) * isqrt(int(square * 10**40)) / 10**20

    hits = 0
    for q in range(0, 120, 10):
        best = sorted(((-cosine(rows[q][1], v), i) for i, v in rows if i != q))[:5]
        hits += len({i for _, i in best} & {i for i, _ in got[q]})
        for i, score in got[q]:
            assert score == pytest.approx(cosine(rows[q][1], rows[i][1]), abs=1e-14)
    assert len(got) == 12 and hits >= 0.9 * 60


def test_any_column_names_pass_all_stages(spark):
    """Names with dots and blanks; a result column that would be there twice is refused."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.withColumn("a.b", F.lit(1)).withColumn("with blank", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, None)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns and after.count() > 0
            docs = after
    assert after.count() > 0
    for make in (lambda c: pseudonyms.pseudonymised(docs, b"k", found_col=c), lambda c: line_dedup.without_repeats(docs, count_col=c)):
        with pytest.raises(ValueError):
            make("A.b")


def test_every_byte_of_a_key_counts():
    one, other = b"k" * 64 + b"1", b"k" * 64 + b"2"
    draw = lambda key: [pseudonyms.Permutation(key, b"t", 10**9)(x) for x in range(20)]
    assert draw(one) != draw(other) and draw(one) != draw(b"k" * 64)
