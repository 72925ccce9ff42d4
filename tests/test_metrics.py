"""Figures, cards and snapshots."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import at, rows
from lendmart.functions.html_cards import read_cards
from lendmart.functions.scalars import metric_value
from lendmart.operators.metrics import extract_labeled, metric_snapshot, with_cards
from lendmart.plans.layers import metric_feed
from lendmart.schemas import METRIC_LABELS

BLOCK = ("div", "col-md-3 col-12", "p", "h5")


def card(label, value, cls="col-md-3 col-12"):
    return f'<div class="{cls}"><p>{label}</p><h5>{value}</h5></div>'


def cards(html, *where):
    return [(c["label"], c["value"]) for c in read_cards(html, *(where or BLOCK))]


FIGURES = {
    "1.5 Ribu": 1500, "12 M": 12_000_000, "1.001 M": 1_000_999, "1234": 1234, "-5": -5, "+7": 7,
    "1e3 Ribu": 1_000_000, " 1 2 ": 12, "1_000": 1000, "-1.5 Ribu": -1500, "0.9999 Ribu": 999,
    ".5 M": 500_000, "5. Ribu": 5000, "1M2": 12_000_000, " 7": 7,
    "12.7": None, "1.234": None, "3 Juta": None, "abc": None, "": None, "1.5 Ribu M": None,
    "1d": None, "2d Ribu": None, "nan M": None, "inf M": None, "1__0": None, "0x10": None,
    "1,5 Ribu": None, "M": None, "99999999999999999999": None, "1e300 M": None, "1 ribu": None,
}


def test_figures(spark):
    df = spark.createDataFrame(list(FIGURES.items()), "text string, expected long")
    got = {r.text: r.got for r in df.select("text", metric_value("text").alias("got")).collect()}
    assert got == FIGURES


def _plain_value(text):
    text = text.replace(" ", "")
    for suffix, factor in (("Ribu", 1_000), ("M", 1_000_000)):
        if suffix in text:
            try:
                return int(float(text.replace(suffix, "")) * factor)
            except (ValueError, OverflowError):
                return None
    try:
        return int(text)
    except ValueError:
        return None


@settings(max_examples=20, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789.+-e_ MRibux", max_size=12), min_size=1, max_size=60))
def test_figures_against_python(spark, texts):
    limit = 2 ** 63
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for text, got in df.select("text", metric_value("text")).collect():
        expected = _plain_value(text)
        if expected is not None and not -limit <= expected < limit:
            expected = None
        assert got == expected, text


def test_card_needs_the_exact_class():
    assert cards(card("A", "1")) == [("A", "1")]
    assert cards(card("A", "1", "col-md-3  col-12")) == [("A", "1")]
    assert cards(card("A", "1", "col-12 col-md-3")) == []
    assert cards(card("A", "1", "col-md-3 col-12 wide")) == []
    assert cards("<div><p>A</p><h5>1</h5></div>") == []


def test_first_title_and_value_count():
    html = '<div class="col-md-3 col-12"><i><p> A <b>b</b> </p></i><p>C</p><h5>1</h5><h5>2</h5></div>'
    assert cards(html) == [("A b", "1")]


def test_incomplete_cards_are_skipped():
    html = '<div class="col-md-3 col-12"><p>A</p></div><div class="col-md-3 col-12"><h5>1</h5></div>'
    assert cards(html + card("B", "2")) == [("B", "2")]


def test_entities_comments_scripts_and_space():
    html = ('<div class="col-md-3 col-12"><!-- <p>no</p> --><p> A &amp; B<script>x</script></p>'
            "<h5>\n 1 </h5></div>")
    assert cards(html) == [("A & B", "1")]
    assert cards('<script><div class="col-md-3 col-12"><p>A</p><h5>1</h5></div></script>') == []


@pytest.mark.parametrize("raw, text", [
    ("a &amp; b", "a & b"), ("a&amp", "a&"), ("&lt;b&gt;", "<b>"), ("&#65;&#x42;", "AB"),
    ("&ampere;", "&ampere"), ("AT&T", "AT&T"), ("1 & 2", "1 & 2"), ("&amp;lt;", "&lt;"),
    ("&nbsp;x&nbsp;", "x"), ("&eacute;", "é"), ("&#150;", "–"),
])
def test_entities(raw, text):
    assert cards(card(raw, "1")) == [(text, "1")]


def test_open_tags_close_at_the_end():
    assert cards('<div class="col-md-3 col-12"><p>A</p><h5>1') == [("A", "1")]
    # An end tag closes what is open inside; one without a start is ignored.
    html = '</p><div class="col-md-3 col-12"><span><p>A</p></em><br/><h5>1</h5></div><p>B</p>'
    assert cards(html) == [("A", "1")]


def test_block_in_a_block():
    inner = card("B", "2")
    outer = f'<div class="col-md-3 col-12">{inner}<p>A</p><h5>1</h5></div>'
    assert cards(outer) == [("B", "2"), ("B", "2")]


def test_other_tags_and_no_class():
    page = "<html><head><title>T</title></head><body><h1>H</h1>"
    assert cards(page, "html", None, "title", "h1") == [("T", "H")]
    assert cards(None) == [] and cards("") == []


def pages(spark, *htmls):
    return spark.createDataFrame(
        [(i, h, at("2025-02-08 03:00:00")) for i, h in enumerate(htmls)],
        "page_id long, html string, created_at timestamp_ntz")


def full(**changes):
    return "".join(card(label, changes.get(f"c{i}", str(i))) for i, label in enumerate(METRIC_LABELS))


def test_extract_keeps_page_order(spark):
    df = pages(spark, card("A", "1") + card("A", "2"), None, "<P>x</P>", card("B", "3").upper())
    assert rows(extract_labeled(df)) == [(0, 0, "A", "1"), (0, 1, "A", "2")]


def test_snapshots(spark):
    df = pages(
        spark, full(), full() + card(METRIC_LABELS[0], "5 M"), full() + card(METRIC_LABELS[0], "?"),
        full(c3="?"), card(METRIC_LABELS[0], "1"), full() + card("Other", "?"), full(),
    ).withColumn("created_at", F.when(F.col("page_id") < 6, F.col("created_at")))
    got = rows(metric_snapshot(with_cards(df)))
    assert [(r[0], r[1]) for r in got] == [(0, 0), (1, 5_000_000), (5, 0)]
    assert got[0][1:11] == tuple(range(10))


def test_pages_are_parsed_once(spark):
    plan = metric_snapshot(with_cards(pages(spark, full())))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1
    assert "Exchange" not in text


def test_feed(spark, database):
    table = f"{database}.metrics"
    assert metric_feed(pages(spark, "nothing here"), table) is False
    assert metric_feed(pages(spark, full(), full(c1="?")), table) is True
    assert metric_feed(pages(spark, full(c0="1.5 Ribu")), table) is True
    stored = spark.table(table)
    assert stored.columns == [*METRIC_LABELS, "created_at"]
    assert sorted(r[0] for r in stored.collect()) == [0, 1500]


@pytest.mark.parametrize("bad", ["<![x", "<!", "<div <p>", "<p/", "&#xZZ;", "<a href='"])
def test_broken_markup_is_no_error(bad):
    assert cards(card("A", "1") + bad) in ([("A", "1")], [])


def test_pages_are_read_in_slices():
    import pyarrow as pa

    from lendmart.functions import html_cards

    for n in (0, 1, html_cards.SLICE_PAGES, 3 * html_cards.SLICE_PAGES + 1):
        parts = list(html_cards._slices(pa.array(map(str, range(n)), pa.string())))
        assert parts and max(map(len, parts)) <= html_cards.SLICE_PAGES
        assert [x for part in parts for x in part.to_pylist()] == [str(k) for k in range(n)]
