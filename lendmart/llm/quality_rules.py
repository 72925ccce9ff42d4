"""Quality rules: line-first cleaning, then a verdict per document.

Each line with a word is judged on its own, but for a missing sentence mark: a line that the
next one continues (a hard-wrapped sentence, up to a line with a mark) is prose. Failing lines
are taken out, and a document that loses more than ``MAX_LOST`` of its words is rejected. A base check comes first: too
few words, or too many words inside repeated eight-word windows.

Defined results: a null text counts as empty and is rejected (no words). A line without a
word is neither judged nor counted. Rows are judged one by one, so repeated rows and ties
get the same verdict each; other columns are passed through untouched.
"""

from __future__ import annotations

import unicodedata

import numpy as np
from pyspark.sql import DataFrame

from lendmart.llm.common import map_rows

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
MAX_LOST = 0.5

# Marks that the rules look for.
SYMBOLS = "#*$%&|<>"
SEPARATORS = frozenset((b"|", b"-", b"/", b">", b"<", b"\xc2\xbb", b"\xc2\xb7", b"\xe2\x80\xa2"))
LOUD = (b"!!", b"??")
SENTENCE_MARKS = (b".", b"!", b"?", b":", b";", b",", b"\xe2\x80\xa6", b'"', b")", b"'", "。".encode())
BOILERPLATE = (
    b"all rights reserved", b"licensed under", b"released under the", b"terms of service", b"terms of use", b"privacy policy", b"cookie policy",
    b"we use cookies", b"accept cookies", b"subscribe to our", b"sign up for our", b"click here",
    b"powered by", b"skip to content", b"javascript is disabled", b"back to top",
)
#: A leading one is a list mark, not a separator or noise.
LIST_MARKS = frozenset((b"-", b"*", b">", b"\xc2\xbb", b"\xc2\xb7", b"\xe2\x80\xa2", b"\xe2\x80\x93"))
NOISE = tuple(bytes((c,)) for c in b"#*$%&<>")

MAX_SEPARATORS = 0.2
MAX_LOUD = 0.3
MAX_NOISE = 0.3
BOILERPLATE_WORDS = 30
UNMARKED_WORDS = 8


def _marked(words: list[bytes]) -> bool:
    """Whether a word ends in a sentence mark: one of the ASCII ones, or other punctuation."""
    for w in words:
        if w.endswith(SENTENCE_MARKS):
            return True
        if w[-1] >= 0x80 and w not in SEPARATORS and unicodedata.category(w.decode(errors="replace")[-1]) in ("Po", "Pe", "Pf", "Pi"):
            return True
    return False


def _continued(line: bytes, after: bytes, width: int) -> bool:
    """Whether ``after`` goes on with the sentence of ``line``: it starts with a letter that
    is no capital, or with a word that a block of ``width`` characters had no room for."""
    follows = after.split(None, 1)
    if not follows:
        return False
    first = follows[0].decode(errors="replace")
    if unicodedata.category(first[0]) in ("Ll", "Lo"):
        return True
    return len(line.decode(errors="replace").rstrip()) + 1 + len(first) > width


def _wrapped(lines: list[bytes]) -> list[bool]:
    """For each line whether it reaches a sentence mark: it has one, or lines of the same block
    continue it up to one that has. No line on the way may have a fault of its own."""
    reach = [False] * len(lines)
    width, stop = 0, len(lines)
    for k in range(len(lines) - 1, -1, -1):
        own = lines[k].split()
        if not own:
            continue
        if k + 1 == len(lines) or not lines[k + 1].split():  # the last line of a block
            start = k
            while start and lines[start - 1].split():
                start -= 1
            width, stop = max(len(x.decode(errors="replace").rstrip()) for x in lines[start : k + 1]), k + 1
        if line_fault(lines[k], own, judge_marks=False):
            continue
        reach[k] = _marked(own) or (k + 1 < stop and reach[k + 1] and _continued(lines[k], lines[k + 1], width))
    return reach


def line_fault(line: bytes, words: list[bytes], judge_marks: bool = True) -> str | None:
    """The first rule that a line (UTF-8, with at least one word) fails, seen alone."""
    n = len(words)
    if words[0] in LIST_MARKS and n > 1:
        words = words[1:]
    if b"|" in line or b">" in line or b"<" in line or b"-" in line or b"/" in line or b"\xc2" in line or b"\xe2" in line:
        separators = sum(w in SEPARATORS for w in words)
        if separators and separators >= MAX_SEPARATORS * n:
            return "navigation"
    if b"!!" in line or b"??" in line:
        if sum(w.endswith(LOUD) for w in words) >= MAX_LOUD * n:
            return "punctuation"
    if any(c in line for c in NOISE):
        noisy = sum(any(c in w for c in NOISE) for w in words)
        if noisy and noisy >= MAX_NOISE * n:
            return "symbols"
    if judge_marks and n >= UNMARKED_WORDS and not _marked(words):
        return "punctuation"
    if n <= BOILERPLATE_WORDS:
        low = line.lower()
        if any(phrase in low for phrase in BOILERPLATE):
            return "boilerplate"
    return None


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in a window of ``window`` words that occurs twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        keys = np.zeros(n, np.uint64)
        for k in range(window):
            keys = keys * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + n]
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    if not len(same):
        return 0
    first, second = order[same], order[same + 1]
    if not all(np.array_equal(ids[first + k], ids[second + k]) for k in range(window)):
        return _repeated_exactly(ids, window)
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.unique(np.concatenate([first, second]))
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def _repeated_exactly(ids: np.ndarray, window: int) -> int:
    """The same by whole windows, for a text in which two windows share a key by chance."""
    seen: dict[tuple, list[int]] = {}
    for i in range(len(ids) - window + 1):
        seen.setdefault(tuple(ids[i : i + window]), []).append(i)
    found = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(window)}
    return len(found)


def judge(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    cleaned text, failed lines) of one text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    blanks = sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = raw.split(b"\n")
    seen: set[bytes] = set()
    repeats, lost, failed, good = 0, 0, 0, []
    reach: list[bool] = []
    for k, line in enumerate(lines):
        own = line.split()
        if own:
            if line in seen:
                repeats += 1
            else:
                seen.add(line)
            fault = line_fault(line, own)
            if fault == "punctuation":
                reach = reach or _wrapped(lines)
                fault = None if reach[k] else fault
            if fault:
                lost += len(own)
                failed += 1
                continue
        good.append(line)
    again = repeated_words(words)
    base_failed = n < MIN_WORDS or 100 * again > MAX_REPEATED_PERCENT * n
    kept = not base_failed and lost <= MAX_LOST * n
    cleaned = text if not failed else b"\n".join(good).decode()
    return n, len(text) - blanks, symbols, repeats, again, base_failed, kept, cleaned, failed


COUNTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean"
)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, the counts and the verdict. No shuffle."""

    def make():
        return lambda ids, texts: [(i, *judge(t)[:7]) for i, t in zip(ids, texts)]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs, [id_col, text_col], make, f"`{id_col}` {kind}, {COUNTS}")


def clean_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns, their text without failed lines."""
    place = docs.columns.index(text_col)

    def make():
        def work(*columns):
            rows = []
            for row in zip(*columns):
                verdict = judge(row[place])
                if verdict[6]:
                    rows.append((*row[:place], verdict[7], *row[place + 1 :]))
            return rows

        return work

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_rows(docs, docs.columns, make, schema)
