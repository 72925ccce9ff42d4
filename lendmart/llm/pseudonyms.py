"""Pseudonyms for personal data by a keyed, format-preserving Feistel permutation.

Numbers and dates are validated first: card numbers by the Luhn sum, account numbers by
their remainder of 97, social security numbers by their ranges, addresses of machines by
their octets or groups, telephone numbers by their length (national, with a trunk prefix 1 or 0,
and with + or 00), dates by the calendar, in figures or with the month's name; mail addresses by
their form. What is valid is ranked within its format, the rank is permuted, and the result
written in the same format, so it is valid again and equal values stay equal in all
documents, however they were spaced.

The permutation is one cycle without fixed points: encrypt, add a keyed step, decrypt.

Defined results: null texts stay null. Rows are treated one by one; columns other than the
text are passed through untouched. Where findings overlap, the leftmost counts, and at the
same start the first in the order of ``FINDERS``.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame

from lendmart.llm.common import map_rows, new_column

ROUNDS = 10


class Permutation:
    """A keyed permutation of 0 .. size - 1 without fixed points (for a size of 2 or more)."""

    def __init__(self, key: bytes, tweak: bytes, size: int):
        self.size = size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.n_bytes = (self.half + 7) // 8
        # A hash takes keys of up to 64 bytes; of longer ones every byte counts through a digest.
        short = key if len(key) <= 64 else hashlib.blake2b(key).digest()
        self.seed = hashlib.blake2b(tweak + b"/%d" % size, key=short, digest_size=32).digest()
        self.step = 1 + int.from_bytes(self._digest(255, 0, 32), "little") % max(1, size - 1)

    def _digest(self, number: int, half: int, n: int) -> bytes:
        data = bytes((number,)) + half.to_bytes(self.n_bytes, "little")
        return hashlib.shake_128(self.seed + data).digest(n)

    def _round(self, number: int, half: int) -> int:
        return int.from_bytes(self._digest(number, half, self.n_bytes), "little") & self.mask

    def _walk(self, x: int, numbers: range, back: bool) -> int:
        while True:
            a, b = x >> self.half, x & self.mask
            for k in numbers:
                a, b = (b ^ self._round(k, a), a) if back else (b, a ^ self._round(k, b))
            x = a << self.half | b
            if x < self.size:  # walk the cycle until inside
                return x

    def __call__(self, x: int) -> int:
        if self.size < 2:
            return x
        inner = self._walk(x, range(ROUNDS), False)
        return self._walk((inner + self.step) % self.size, range(ROUNDS - 1, -1, -1), True)


_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _alphabet(c: str) -> str:
    return _DIGITS if c in _DIGITS else _UPPER if c in _UPPER else _LOWER if c in _LOWER else ""


def _permute_characters(text: str, key: bytes, tweak: bytes) -> str:
    """Digits to digits, letters to letters of the same case, the rest as it is."""
    sets = [_alphabet(c) for c in text]
    shape = "".join(s[0] if s else c for s, c in zip(sets, text)).encode()
    rank, size = 0, 1
    for c, s in zip(text, sets):
        if s:
            rank, size = rank * len(s) + s.index(c), size * len(s)
    rank = Permutation(key, tweak + b"/" + shape, size)(rank)
    out = []
    for c, s in zip(reversed(text), reversed(sets)):
        if s:
            rank, k = divmod(rank, len(s))
            c = s[k]
        out.append(c)
    return "".join(reversed(out))


def _refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if "0" <= c <= "9" else c for c in text)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn_sum(digits: str) -> int:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10


def _mail(m: re.Match, key: bytes) -> str | None:
    local, _, host = m[0].partition("@")
    return f"{_permute_characters(local, key, b'mail')}@{host}"


def _account(m: re.Match, key: bytes) -> str | None:
    plain = m[0].replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _permute_characters(plain[4:], key, b"account/" + plain[:2].encode())
    new = iter(plain[:2] + f"{98 - number(body + plain[:2] + '00') % 97:02d}" + body)
    return "".join(c if c == " " else next(new) for c in m[0])


def _card(m: re.Match, key: bytes) -> str | None:
    digits = _only_digits(m[0])
    if not 13 <= len(digits) <= 19 or _luhn_sum(digits) or len(set(digits)) == 1:
        return None
    width = len(digits) - 2
    inner = Permutation(key, b"card/" + digits[:1].encode(), 10**width)(int(digits[1:-1]))
    head = digits[0] + str(inner).rjust(width, "0")
    return _refill(m[0], head + str(-_luhn_sum(head + "0") % 10))


def _social(m: re.Match, key: bytes) -> str | None:
    area, group, serial = int(m[0][:3]), int(m[0][4:6]), int(m[0][7:])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rank, serial = divmod(Permutation(key, b"social", 898 * 99 * 9999)(rank), 9999)
    area, group = divmod(rank, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


FIRST_DAY, DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


def _date(m: re.Match, key: bytes) -> str | None:
    mark = next(c for c in m[0] if c in "-/.")
    parts = m[0].split(mark)
    if len(parts[0]) == 4:
        orders = ((0, 1, 2),)
    else:
        orders = ((2, 1, 0), (2, 0, 1))  # day first, and month first if that is no date
    for order in orders:
        try:
            day = date(*(int(parts[k]) for k in order))
        except ValueError:
            continue
        rank = (day - FIRST_DAY).days
        if not 0 <= rank < DAYS:
            return None
        new = FIRST_DAY + timedelta(Permutation(key, b"date", DAYS)(rank))
        out = [""] * 3
        for k, v in zip(order, (new.year, new.month, new.day)):
            out[k] = str(v).rjust(len(parts[k]) if parts[k][0] == "0" or len(parts[k]) > 1 else 1, "0")
        return mark.join(out)
    return None


#: Names of the months, a style a row; a name in two rows belongs to the first.
MONTHS = tuple(row.split() for row in (
    "january february march april may june july august september october november december",
    "jan feb mar apr may jun jul aug sep oct nov dec",
    "januar februar märz april mai juni juli august september oktober november dezember",
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
))
_MONTH = {name: (row, k) for row in reversed(MONTHS) for k, name in enumerate(row, 1)} | {"sept": (MONTHS[1], 9)}


def _named_date(m: re.Match, key: bytes) -> str | None:
    """A date with the month's name; the rank is that of the date in figures."""
    row, month = _MONTH[m["month"].lower()]
    try:
        day = date(int(m["year"]), month, int(m["day"]))
    except ValueError:
        return None
    new = FIRST_DAY + timedelta(Permutation(key, b"date", DAYS)((day - FIRST_DAY).days))
    name, old = row[new.month - 1], m["month"]
    name = name.upper() if old.isupper() else name if old.islower() else name.capitalize()
    th = m["th"] or ""
    if th.lower() in ("st", "nd", "rd", "th"):
        th = "th" if 11 <= new.day <= 13 else {1: "st", 2: "nd", 3: "rd"}.get(new.day % 10, "th")
    figures = str(new.day).rjust(2 if m["day"][0] == "0" else 1, "0")
    parts = {"day": figures, "th": th, "month": name, "year": str(new.year)}
    out, at = [], m.start()
    for group in sorted((g for g in parts if m[g] is not None), key=m.start):
        out += [m.string[at : m.start(group)], parts[group]]
        at = m.end(group)
    return "".join(out)


class _EndsInYear:
    """Dates with named months: looked for before each year, so a text without costs a search."""

    year = re.compile(r"(?:19|20)[0-9]{2}(?![0-9A-Za-z])")
    _names = "(?P<month>" + "|".join(sorted(_MONTH, key=len, reverse=True)) + ")"
    patterns = tuple(re.compile(p + r"(?P<year>[0-9]{4})\Z", re.I) for p in (
        r"(?<![^\W_])(?<![0-9][-/.])(?P<day>[0-9]{1,2})(?P<th>st|nd|rd|th|er|\.|º)?[ -](?:of |de )?" + _names + r"\.?(?:, ?| de | del |[ -])",
        r"(?<![^\W_])" + _names + r"\.?[ -](?:the )?(?P<day>[0-9]{1,2})(?P<th>st|nd|rd|th)?(?:, ?|[ -])",
    ))

    @classmethod
    def finditer(cls, text: str):
        for year in cls.year.finditer(text):
            for pattern in cls.patterns:
                if m := pattern.search(text, max(0, year.start() - 32), year.end()):
                    yield m
                    break


def _machine_v6(m: re.Match, key: bytes) -> str | None:
    if not _DIGIT.search(m[0]):
        return None
    try:
        own = ipaddress.IPv6Address(m[0])
    except ValueError:
        return None
    new = ipaddress.IPv6Address(Permutation(key, b"machine6", 1 << 128)(int(own)))
    out = new.compressed if "::" in m[0] else new.exploded
    return out.upper() if m[0] == m[0].upper() and m[0] != m[0].lower() else out


def _machine(m: re.Match, key: bytes) -> str | None:
    octets = m[0].split(".")
    if any(int(o) > 255 or o != str(int(o)) for o in octets):
        return None
    rank = Permutation(key, b"machine", 1 << 32)(int.from_bytes(bytes(map(int, octets)), "big"))
    return ".".join(map(str, rank.to_bytes(4, "big")))


def _telephone(m: re.Match, key: bytes) -> str | None:
    digits = _only_digits(m[0])
    head = ""
    if m[0][0] == "+" or digits[:2] == "00":
        if m[0][0] != "+":
            head, digits = "00", digits[2:]
        if not 8 <= len(digits) <= 15:
            return None
        country = digits[:1] if digits[0] in "17" else digits[:2]
        if country[0] == "0":
            return None
    elif len(digits) == 11 and digits[0] == "1":
        country = "1"  # the trunk prefix of +1
    elif digits[0] == "0":
        # After another trunk prefix the country is unknown; the next digit is never 0.
        if not 9 <= len(digits) <= 12:
            return None
        least = 10 ** (len(digits) - 2)
        own = Permutation(key, b"telephone/0", 9 * least)(int(digits) - least)
        return _refill(m[0], "0" + str(own + least))
    else:
        country = ""
        if len(digits) != 10 or digits[0] in "01":
            return None
    own = digits[len(country) :]
    tweak = b"telephone/" + (country or "1").encode()
    new = Permutation(key, tweak, 10 ** len(own))(int(own))
    return _refill(m[0], head + country + str(new).rjust(len(own), "0"))


_DIGIT = re.compile("[0-9]")
_EDGE = r"(?<![0-9A-Za-z])"
_STOP = r"(?![0-9A-Za-z])"
FINDERS: tuple[tuple[str, re.Pattern, Callable], ...] = (
    ("mail", re.compile(
        r"(?<![A-Za-z0-9._%+-])(?=[^@\s]{1,64}+@)[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+"
    ), _mail),
    ("account", re.compile(_EDGE + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _STOP), _account),
    ("card", re.compile(_EDGE + r"(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![0-9A-Za-z]|[ -][0-9])"), _card),
    ("social", re.compile(_EDGE + r"(?<![0-9]-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])"), _social),
    ("date", re.compile(
        _EDGE + r"(?<![0-9][-/.])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?:(?=T[0-9]{2}(?::?[0-9]{2})?)|(?![0-9A-Za-z]|[-/.][0-9]))"
    ), _date),
    ("date", _EndsInYear, _named_date),
    ("machine", re.compile(_EDGE + r"(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"), _machine),
    ("machine", re.compile(
        r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{0,4}:)(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:]|\.[0-9])"
    ), _machine_v6),
    ("telephone", re.compile(
        r"(?:(?<![0-9A-Za-z+])\+|(?<![0-9A-Za-z+])(?<![0-9][ .-])00[ .-]?(?=[1-9]))[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9A-Za-z])"
        r"|" + _EDGE + r"(?<![0-9][ .-])(?:1[ .-]|1(?=\())?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[ .-][0-9])"
        r"|" + _EDGE + r"(?<![0-9][ .-])(?:\(0[1-9][0-9]{1,4}\) ?|0[1-9][0-9]{1,4}[ /-])[0-9]{3,8}(?:[ -][0-9]{2,4}){0,3}(?![0-9A-Za-z]|[ .-][0-9])"
    ), _telephone),
)
def pseudonymise(text: str | None, key: bytes) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The text with its personal data replaced, and (kind, start, end) in the given text."""
    if not text or ("@" not in text and not _DIGIT.search(text)):
        return text, []
    digits = bool(_DIGIT.search(text))
    hits = []
    for order, (kind, pattern, replace) in enumerate(FINDERS):
        if not ("@" in text if kind == "mail" else digits):
            continue
        for m in pattern.finditer(text):
            if (new := replace(m, key)) is not None:
                hits.append((m.start(), order, m.end(), kind, new))
    out, at, found = [], 0, []
    for start, _, end, kind, new in sorted(hits):
        if start >= at:
            out += [text[at:start], new]
            found.append((kind, start, end))
            at = end
    return "".join([*out, text[at:]]), found


FOUND = "array<struct<kind:string,start:int,end:int>>"


def pseudonymised(docs: DataFrame, key: bytes, text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """``docs`` with the text replaced, all columns; ``found_col`` adds what was found, its
    places in the given text, and is a new column. ``key`` is the secret that links the
    pseudonyms."""
    new_column(docs, found_col)
    place = docs.columns.index(text_col)

    def make():
        def work(*columns):
            rows = []
            for row in zip(*columns):
                text, found = pseudonymise(row[place], key)
                row = (*row[:place], text, *row[place + 1 :])
                rows.append((*row, found) if found_col else row)
            return rows

        return work

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_rows(docs, docs.columns, make, schema + (f", `{found_col}` {FOUND}" if found_col else ""))
