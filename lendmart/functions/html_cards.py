"""Labelled values out of HTML pages.

HTML found in the wild leaves tags open, so neither Spark's XPath functions
(well-formed XML only) nor regular expressions can tell what lies inside a
block. The one Python step of the package reads the tag stream of a page with
the standard parser and hands back all (label, value) pairs of that page, so
everything after it is plain column work on the same row and needs no shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

CARDS = T.ArrayType(
    T.StructType([T.StructField("label", T.StringType()), T.StructField("value", T.StringType())])
)

# Pages that a task holds as Python text at a time, whatever the size of an Arrow batch.
SLICE_PAGES = 64

# Elements that never have content.
VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
# Elements whose text is not part of the text around them.
HIDDEN_TEXT = frozenset(("script", "style", "template"))


class _CardReader(HTMLParser):
    """Collects, per matching block, the text of its first title and value tag.

    An end tag closes the nearest open element of its name and all inside it;
    without one it is ignored. Whatever is open at the end of the page counts as
    closed there. A block inside a block is one more block.
    """

    def __init__(self, block: str, cls: str | None, title: str, value: str):
        super().__init__(convert_charrefs=False)
        self._block, self._cls = block, cls
        self._wanted = (title, value)
        self._open: list[str] = []
        self._count: dict[str, int] = {}
        self._blocks: list[tuple[int, list]] = []   # open: (depth, [title, value])
        self._texts: list[tuple[int, str, list]] = []  # open: (depth, tag, parts)
        self.found: list[list] = []

    def handle_starttag(self, tag, attrs):
        depth = len(self._open)
        if tag in self._wanted:
            # An element may be the first of its kind for several open blocks.
            parts: list[str] = []
            used = False
            for _, slots in self._blocks:
                for i, name in enumerate(self._wanted):
                    if name == tag and slots[i] is None:
                        slots[i] = parts
                        used = True
            if used and tag not in VOID:
                self._texts.append((depth, tag, parts))
        if tag == self._block and self._matches(attrs):
            slots = [None, None]
            self.found.append(slots)
            if tag not in VOID:
                self._blocks.append((depth, slots))
        if tag not in VOID:
            self._open.append(tag)
            self._count[tag] = self._count.get(tag, 0) + 1

    def _matches(self, attrs) -> bool:
        if self._cls is None:
            return True
        return any(
            name == "class" and " ".join((text or "").split()) == self._cls
            for name, text in attrs
        )

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self._count.get(tag):
            return
        while True:
            name = self._open.pop()
            self._count[name] -= 1
            if name == tag:
                break
        depth = len(self._open)
        while self._blocks and self._blocks[-1][0] >= depth:
            self._blocks.pop()
        while self._texts and self._texts[-1][0] >= depth:
            self._texts.pop()

    def handle_entityref(self, name):
        # An unknown name stays as it is, also if it begins like a known one.
        self.handle_data(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        self.handle_data(unescape(f"&#{name};"))

    def handle_data(self, data):
        if not self._texts:
            return
        holder = self._open[-1] if self._open else ""
        for _, tag, parts in self._texts:
            if holder not in HIDDEN_TEXT or holder == tag:
                parts.append(data)


def read_cards(html: str | None, block: str, cls: str | None, title: str, value: str) -> list[dict]:
    """All (label, value) pairs of one page, in page order."""
    if not html:
        return []
    reader = _CardReader(block, cls, title, value)
    try:
        reader.feed(html)
        reader.close()
    except AssertionError:  # markup the parser rejects: the page has no cards
        return []
    return [
        {"label": "".join(label).strip(), "value": "".join(text).strip()}
        for label, text in reader.found
        if label is not None and text is not None
    ]


def _slices(pages: pa.Array) -> Iterator[pa.Array]:
    """An array in pieces of ``SLICE_PAGES``, one at least."""
    for start in range(0, max(len(pages), 1), SLICE_PAGES):
        yield pages.slice(start, SLICE_PAGES)


# Ship this module's code with the function, so executors need no install of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def cards(html: Column, block: str, cls: str | None, title: str, value: str) -> Column:
    """All (label, value) pairs of each page as an array, in page order."""

    kind = to_arrow_type(CARDS)

    @F.arrow_udf(CARDS)
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.concat_arrays([
                pa.array([read_cards(page, block, cls, title, value) for page in part.to_pylist()], kind)
                for part in _slices(pages)
            ])

    # A page that lacks one of the start tags yields nothing, so its text need
    # not travel to Python.
    lowered = F.lower(html)
    present = F.lit(True)
    for tag in dict.fromkeys((block, title, value)):
        present = present & F.contains(lowered, F.lit("<" + tag))
    # Declared non-deterministic only so that a filter on the result is not moved
    # below it, which would parse every page a second time.
    return parse.asNondeterministic()(F.when(present, html))
