"""Secret scan: fixed patterns, and a character convolutional network over the candidates.

One pass over the texts finds the base spans and the candidates: runs of eight or more value
characters that hold a digit or follow ``:`` or ``=``; other runs, mostly plain words, are
left out. Every candidate that no base span
covers goes to a small network (character vectors, one convolution, pooling, one output)
together with the text around it. The network is trained on all labelled findings; half of
the findings held out set the calibration, the other half the thresholds: per alphabet the
highest that still finds ``RECALL`` of the held-out secrets. An alphabet with fewer than
``LEAST_HELD`` of them takes the threshold of all held-out secrets together.

Up to ``AT_ONCE`` findings are trained on by the driver. More stay in Spark: groups of some
``GROUP`` of them train side by side from the same weights, pass by pass, and the next pass
starts from the mean of their weights. Calibration and thresholds are aggregates over all
findings held out.

Defined results: a null text counts as empty. Rows are scanned one by one, so repeated rows
give repeated results. Without ``LEAST_FINDINGS`` findings of either label (an empty table,
say) there is no network and the base spans stand alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lendmart.llm.common import map_rows, ship, stored

KINDS = ("assign", "access", "hex", "network")

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
# A run of 32 starts with 32 hexadecimal digits; the possessive run keeps the scan linear.
HEX_RUN = re.compile(r"(?<![0-9a-f])[0-9a-f]{32}[0-9a-f]*+")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}+")
VALUE = re.compile(r"[A-Za-z0-9+/_.=-]+")
CUE = re.compile(r"[0-9]|[:=]")
FOLLOWS = re.compile(r"""[:=]["']?\x20*["']?$""")

LEFT, BODY, RIGHT = 24, 64, 16
WIDTH = LEFT + BODY + RIGHT
#: So many different findings are trained on in one place; more are dealt to groups.
AT_ONCE = 4096
GROUP = 2048
LEAST_FINDINGS = 8
EPOCHS, SEED = 8, 7
RECALL = 0.95
#: So many held-out secrets allow one to be missed.
LEAST_HELD = 20
_VALUE_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base patterns, in code points, by start and kind."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        spans += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    spans += [(2, m.start(), m.end()) for m in HEX_RUN.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], s[0]))


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of all candidates, in order."""
    found, at = [], 0
    while cue := CUE.search(text, at):
        here = cue.start()
        if cue[0] == ":":
            start = here + 1
        else:
            start = here
            while start > at and text[start - 1] in _VALUE_CHARS:
                start -= 1
        run = VALUE.match(text, start)
        if cue[0] in ":=" and (not run or run.end() <= here + 1):  # a value may follow the mark
            start = here + 1
            while start < len(text) and text[start] in " \"'" and start - here <= 4:
                start += 1
            run = VALUE.match(text, start)
        if run and run.end() - run.start() >= 8:
            found.append(run.span())
        at = max(here + 1, run.end() if run else 0)
    return found


def windows(text: str, start: int, end: int) -> list[str]:
    """The candidate in pieces of ``BODY`` characters, each with the text around it."""
    out = []
    for at in range(start, end, BODY):
        stop = min(at + BODY, end)
        left = text[max(0, at - LEFT) : at].rjust(LEFT, "\0")
        out.append(left + text[at:stop].ljust(BODY, "\0") + text[stop : stop + RIGHT].ljust(RIGHT, "\0"))
    return out


def alphabet(window: str) -> int:
    """0: digits and marks only; 1: hexadecimal of one case; 2: anything else."""
    body = window[LEFT : LEFT + BODY].rstrip("\0")
    if not re.search("[A-Za-z]", body):
        return 0
    return 1 if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", body) else 2


def scan(text: str | None) -> tuple[list, list]:
    """Base spans, and (start, end, covered by a base span, windows) of the candidates."""
    text = text or ""
    spans = base_spans(text)
    found = []
    for start, end in candidates(text):
        covered = any(s < end and start < e for _, s, e in spans)
        found.append((start, end, covered, windows(text, start, end)))
    return spans, found


# --- the network --------------------------------------------------------------------------
def _codes(texts: list[str]) -> np.ndarray:
    """Character numbers: printable ASCII 1-95, 0 for padding, 96 for the rest."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(len(texts), WIDTH).astype(np.int64)
    return np.where(flat == 0, 0, np.where((flat >= 32) & (flat < 127), flat - 31, 96))


@dataclass
class Network:
    """Weights, calibration (slope, shift) and a threshold per alphabet."""

    weights: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    thresholds: tuple[float, ...] = (0.5, 0.5, 0.5)

    def logits(self, texts: list[str]) -> np.ndarray:
        out = [_forward(self.weights, _codes(texts[i : i + 512]))[0] for i in range(0, len(texts), 512)]
        return np.concatenate(out) if out else np.zeros(0)

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.calibrated(self.logits(texts))

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -40, 40)))

    def flags(self, texts: list[str]) -> np.ndarray:
        limits = np.array([self.thresholds[alphabet(t)] for t in texts])
        return self.scores(texts) >= limits


CHAR_DIM, FILTERS, SPAN = 8, 16, 5
_PLACE = np.zeros((WIDTH, 3), np.float32)
_PLACE[:LEFT, 0] = _PLACE[LEFT : LEFT + BODY, 1] = _PLACE[LEFT + BODY :, 2] = 1


def _forward(w: dict, codes: np.ndarray):
    n = len(codes)
    chars = np.concatenate([w["chars"][codes], np.broadcast_to(_PLACE, (n, WIDTH, 3))], axis=2)
    steps = WIDTH - SPAN + 1
    view = np.lib.stride_tricks.sliding_window_view(chars, SPAN, axis=1)  # n, steps, dim, span
    patches = np.ascontiguousarray(view).reshape(n * steps, -1)
    hidden = np.maximum(patches @ w["conv"] + w["conv_bias"], 0).reshape(n, steps, FILTERS)
    top = hidden.argmax(axis=1)
    pooled = np.concatenate([np.take_along_axis(hidden, top[:, None], 1)[:, 0], hidden.mean(axis=1)], axis=1)
    return pooled @ w["out"] + w["out_bias"], (codes, patches, hidden, top, pooled)


def _gradients(w: dict, saved, slip: np.ndarray) -> dict:
    codes, patches, hidden, top, pooled = saved
    n, steps = hidden.shape[:2]
    back = slip[:, None] * w["out"][None]
    d_hidden = np.repeat(back[:, None, FILTERS:] / steps, steps, axis=1)
    rows = np.arange(n)[:, None], top, np.arange(FILTERS)[None]
    d_hidden[rows] += back[:, :FILTERS]
    d_hidden = (d_hidden * (hidden > 0)).reshape(n * steps, FILTERS)
    d_patch = (d_hidden @ w["conv"].T).reshape(n, steps, CHAR_DIM + 3, SPAN)
    d_chars = np.zeros((n, WIDTH, CHAR_DIM), np.float32)
    for k in range(SPAN):
        d_chars[:, k : k + steps] += d_patch[:, :, :CHAR_DIM, k]
    table = np.zeros_like(w["chars"])
    np.add.at(table, codes.ravel(), d_chars.reshape(-1, CHAR_DIM))
    return {
        "chars": table, "conv": patches.T @ d_hidden, "conv_bias": d_hidden.sum(axis=0),
        "out": pooled.T @ slip, "out_bias": slip.sum(keepdims=True),
    }


def _start(rng) -> dict:
    draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    return {
        "chars": draw(97, CHAR_DIM), "conv": draw((CHAR_DIM + 3) * SPAN, FILTERS) * 0.6,
        "conv_bias": np.zeros(FILTERS, np.float32), "out": draw(2 * FILTERS), "out_bias": np.zeros(1, np.float32),
    }


def _descend(w: dict, first: dict, second: dict, step: int, codes: np.ndarray, goal: np.ndarray, rng) -> int:
    """One pass over the findings in batches of 64, in place; both labels weigh the same.
    Returns the number of steps so far."""
    weight = np.where(goal == 1, 0.5 / max(goal.mean(), 1e-6), 0.5 / max(1 - goal.mean(), 1e-6)).astype(np.float32)
    for part in np.array_split(rng.permutation(len(goal)), max(1, len(goal) // 64)):
        step += 1
        logits, saved = _forward(w, codes[part])
        slip = ((1 / (1 + np.exp(-np.clip(logits, -30, 30))) - goal[part]) * weight[part] / len(part)).astype(np.float32)
        for k, g in _gradients(w, saved, slip).items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            w[k] -= 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    return step


def train(findings: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = SEED) -> Network | None:
    """A network from (window, 0 or 1) findings; None if there are too few of either label.

    Equal windows count once, and a window of both labels is in one part only. Half the
    findings train; a quarter each calibrates and sets thresholds. Training windows
    of secrets, and only those, are also taken with the text around another finding and with
    values drawn from other alphabets, so that neither one keyword nor one alphabet decides.
    """
    rng = np.random.default_rng(seed)
    by_label = [list(dict.fromkeys(w for w, y in findings if y == label)) for label in (0, 1)]
    if min(map(len, by_label)) < LEAST_FINDINGS:
        return None
    train_set, calibration, held = [], [], []
    part: dict[str, list] = {}
    for label, texts in enumerate(by_label):
        for i, k in enumerate(rng.permutation(len(texts))):
            part.setdefault(texts[k], (train_set, calibration, train_set, held)[i % 4]).append((texts[k], label))
    plain = [w for w, y in train_set if y == 0]
    train_set += [(v, 1) for w, y in train_set if y for v in _variants(w, plain, rng)]

    codes = _codes([w for w, _ in train_set])
    goal = np.array([y for _, y in train_set], np.float32)
    w = _start(rng)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    least_steps = 60
    while step < max(least_steps, epochs * len(goal) // 64):
        step = _descend(w, first, second, step, codes, goal, rng)
    network = Network(w)
    _calibrate(network, calibration)
    secrets = [x for x, y in held if y]
    network.thresholds = _limits(network.scores(secrets), [alphabet(x) for x in secrets])
    return network


def _limits(scores: np.ndarray, groups: list[int]) -> tuple[float, ...]:
    """The threshold of each alphabet: the highest that finds ``RECALL`` of its held-out
    secrets, or of all if it has fewer than ``LEAST_HELD``."""
    limits = []
    for group in range(3):
        own = scores[np.array(groups) == group]
        own = np.sort(own if len(own) >= LEAST_HELD else scores)
        limits.append(float(own[int(len(own) * (1 - RECALL) + 1e-9)]))
    return tuple(limits)


def _variants(window: str, plain: list[str], rng) -> list[str]:
    body = window[LEFT : LEFT + BODY]
    n = len(body.rstrip("\0"))
    out = []
    for letters in ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"):
        other = plain[rng.integers(len(plain))] if plain else window
        value = "".join(letters[i] for i in rng.integers(len(letters), size=n)).ljust(BODY, "\0")
        out.append(window[:LEFT] + value + window[LEFT + BODY :])
        out.append(other[:LEFT] + value + other[LEFT + BODY :])
    return out


def _calibrate(network: Network, part: list[tuple[str, int]]) -> None:
    """Platt scaling by Newton steps, with a weak pull to slope 1 and shift 0."""
    x, y = network.logits([w for w, _ in part]), np.array([y for _, y in part], float)
    slope, shift = 1.0, 0.0
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
        g = np.array([((p - y) * x).sum() + slope - 1, (p - y).sum() + shift])
        v = p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum() + 1]])
        slope, shift = np.array([slope, shift]) - np.linalg.solve(h, g)
    network.slope, network.shift = max(float(slope), 0.05), float(shift)


# --- Spark --------------------------------------------------------------------------------
SPANS = "array<struct<kind:string,start:int,end:int>>"
_FOUND = "array<struct<start:int,end:int,covered:boolean,windows:array<string>>>"


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base spans, candidates) per row, stored: the texts are read once."""

    def make():
        def work(ids, texts):
            rows = []
            for i, text in zip(ids, texts):
                spans, found = scan(text)
                rows.append((i, [(KINDS[k], s, e) for k, s, e in spans], found))
            return rows

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return stored(map_rows(docs, [id_col, text_col], make, f"`{id_col}` {kind}, base {SPANS}, found {_FOUND}"), "secrets")


def labelled_windows(table: DataFrame) -> DataFrame:
    """(window, label) of all different findings: candidates inside a base span are secrets,
    the others are not. Copies of a window count once."""
    return table.select(F.explode("found").alias("f")).select(
        F.col("f.covered").cast("int").alias("label"), F.explode("f.windows").alias("window")
    ).distinct().select("window", "label")


def labelled_findings(table: DataFrame, most: int) -> list[tuple[str, int]]:
    """Findings as ``train`` takes them, those least by hash: ``most`` of either label, or all
    if there are no more."""
    each = labelled_windows(table)
    out = []
    for label in (0, 1):
        part = each.where(F.col("label") == label).orderBy(F.xxhash64("window"), "window").limit(most)
        out += [(r["window"], label) for r in part.collect()]
    return out


def fit(table: DataFrame) -> Network | None:
    """The network of all labelled findings of a scanned table."""
    windows = stored(labelled_windows(table), "secrets")
    counts = {r["label"]: r["count"] for r in windows.groupBy("label").count().collect()}
    if min(counts.get(label, 0) for label in (0, 1)) < LEAST_FINDINGS:
        return None
    if sum(counts.values()) <= AT_ONCE:
        return train(labelled_findings(table, AT_ONCE))
    parts = stored(_parts(windows), "secrets")
    network = Network(_trained(parts.where(F.col("part").isin(0, 2))))
    apart = _logits(parts.where(F.col("part") == 1), network)
    network.slope, network.shift = _platt(apart)
    held = _logits(parts.where((F.col("part") == 3) & (F.col("label") == 1)), network)
    network.thresholds = tuple(float(network.calibrated(x)) for x in _held_limits(held))
    return network


def _parts(windows: DataFrame) -> DataFrame:
    """(window, label, part): a window of both labels is in one part only. Parts 0 and 2
    train, 1 calibrates, 3 sets thresholds. Windows are dealt by hash; of a label with few
    they are dealt by turns, so that no part lacks it."""
    each = windows.groupBy("window").agg(F.max("label").alias("kind"), F.min("label").alias("least"))
    hashed = F.xxhash64("window")
    few = [r["kind"] for r in each.groupBy("kind").count().where(F.col("count") <= AT_ONCE).collect()]
    turn = F.row_number().over(Window.partitionBy("kind").orderBy(hashed, "window")) - 1
    dealt = each.where(~F.col("kind").isin(few)).withColumn("turn", hashed).unionByName(
        each.where(F.col("kind").isin(few)).withColumn("turn", turn.cast("long")))
    return dealt.select(
        "window", F.explode(F.array_distinct(F.array("least", "kind"))).alias("label"),
        F.pmod("turn", F.lit(4)).cast("int").alias("part"))


def _dealt(rows: DataFrame) -> DataFrame:
    """(window, label, group, groups): every finding is in a group, those of a label that is
    rare in several, so that each group has both."""
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    groups = -(-sum(counts.values()) // GROUP)
    copies = F.lit(1)
    for label, n in counts.items():
        copies = F.when(F.col("label") == label, min(groups, -(-groups * GROUP // (4 * n)))).otherwise(copies)
    return rows.select(
        "window", "label", F.explode(F.sequence(F.lit(0), copies.cast("int") - 1)).alias("copy"),
    ).select(
        "window", "label", F.pmod(F.pmod(F.xxhash64(F.lit(1), "window"), F.lit(groups)) + F.col("copy"), F.lit(groups)).alias("group"),
        F.lit(groups).alias("groups"))


#: Weights are added up as whole numbers, so that their mean does not depend on the order.
_ONE = 1 << 36


def _trained(rows: DataFrame) -> dict[str, np.ndarray]:
    """Weights after ``EPOCHS`` passes of all groups, averaged after each. Only one network's
    weights and moments go to the driver."""
    dealt = stored(_dealt(rows), "secrets")
    w = _start(np.random.default_rng(SEED))
    state = [w, *({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))]
    ship(rows.sparkSession)
    for epoch in range(EPOCHS):
        flat = dealt.groupBy("group").applyInPandas(_group_pass(state, epoch), "step long, state array<double>")
        summed = flat.select("step", F.posexplode("state").alias("at", "value")).groupBy("at").agg(
            F.sum(F.round(F.col("value") * _ONE).cast("long")).alias("sum"), F.count("*").alias("n"))
        values = np.array([r["sum"] / r["n"] / _ONE for r in summed.orderBy("at").collect()])
        state, at = [{k: np.zeros_like(v) for k, v in part.items()} for part in state], 0
        for part in state:
            for k, v in part.items():
                v[...] = values[at : at + v.size].reshape(v.shape)
                at += v.size
    return state[0]


def _group_pass(state: list[dict], epoch: int):
    """A pass of one group from ``state`` (weights and moments)."""

    def run(key, rows):
        rows = rows.sort_values(["window", "label"])
        rng = np.random.default_rng([SEED, int(key[0])])
        found = list(zip(rows["window"], rows["label"]))
        plain = [x for x, y in found if y == 0]
        found += [(v, 1) for x, y in found if y for v in _variants(x, plain, rng)]
        w, first, second = ({k: v.copy() for k, v in part.items()} for part in state)
        goal = np.array([y for _, y in found], np.float32)
        steps, whole = max(1, len(goal) // 64), np.random.default_rng([SEED, int(key[0]), epoch])
        step = _descend(w, first, second, epoch * steps, _codes([x for x, _ in found]), goal, whole)
        flat = np.concatenate([v.ravel() for part in (w, first, second) for v in part.values()])
        return pd.DataFrame({"step": [step], "state": [flat.astype(float).tolist()]})

    return run


def _logits(rows: DataFrame, network: Network) -> DataFrame:
    """(logit, label, alphabet) of findings, stored."""

    def make():
        def work(windows, labels):
            return [(float(x), y, alphabet(t)) for x, y, t in zip(network.logits(windows), labels, windows)]

        return work

    return stored(map_rows(rows, ["window", "label"], make, "logit double, label int, alphabet int"), "secrets")


def _platt(apart: DataFrame) -> tuple[float, float]:
    """``_calibrate`` by aggregates."""
    slope, shift = 1.0, 0.0
    x, y = F.col("logit"), F.col("label")
    for _ in range(25):
        bounded = F.greatest(F.least(F.lit(slope) * x + F.lit(shift), F.lit(30.0)), F.lit(-30.0))
        p = 1 / (1 + F.exp(-bounded))
        v = p * (1 - p)
        sums = apart.agg(*[F.sum(c) for c in ((p - y) * x, p - y, v * x * x, v * x, v)]).first()
        gx, g, xx, vx, one = (s or 0.0 for s in sums)
        move = np.linalg.solve(np.array([[xx + 1, vx], [vx, one + 1]]), np.array([gx + slope - 1, g + shift]))
        slope, shift = slope - float(move[0]), shift - float(move[1])
        if np.abs(move).max() < 1e-9:
            break
    return max(slope, 0.05), shift


def _held_limits(held: DataFrame) -> list[float]:
    """``_limits`` as logits, by counts."""
    counts = {r["alphabet"]: r["count"] for r in held.groupBy("alphabet").count().collect()}
    limit = lambda rows, n: _kth(rows, int(n * (1 - RECALL) + 1e-9))
    whole = limit(held, sum(counts.values())) if min(counts.get(g, 0) for g in range(3)) < LEAST_HELD else None
    return [
        limit(held.where(F.col("alphabet") == g), counts[g]) if counts.get(g, 0) >= LEAST_HELD else whole for g in range(3)
    ]


def _kth(rows: DataFrame, k: int) -> float:
    """The logit that ``k`` others precede in order. Counts of a thousand ranges tell the range it lies in,
    until that is a single value."""
    low, high = rows.agg(F.min("logit"), F.max("logit")).first()
    while low < high:
        within = rows.where(F.col("logit").between(low, high))
        place = F.floor((F.col("logit") - F.lit(low)) / F.lit(high - low) * F.lit(1000.0))
        ranges = within.groupBy(place.alias("place")).agg(
            F.count("*").alias("n"), F.min("logit").alias("low"), F.max("logit").alias("high"))
        for r in ranges.orderBy("place").collect():
            if k < r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
    return low


def find_secrets(
    docs: DataFrame, findings: list[tuple[str, int]] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, base, spans): base spans, and all spans with the network's. ``findings`` are
    labelled windows; without them the base spans of ``docs`` label its own candidates."""
    table = scanned(docs, id_col, text_col)
    network = fit(table) if findings is None else train(findings)
    order = {k: i for i, k in enumerate(KINDS)}

    def make():
        def work(ids, base, found):
            open_ = [(r, c) for r, each in enumerate(found) for c in each if not c["covered"]]
            texts = [w for _, c in open_ for w in c["windows"]]
            hits = network.flags(texts) if network and texts else np.zeros(len(texts), bool)
            spans = [[(s["kind"], s["start"], s["end"]) for s in each] for each in base]
            at = 0
            for r, c in open_:
                if hits[at : at + len(c["windows"])].any():
                    spans[r].append((KINDS[3], c["start"], c["end"]))
                at += len(c["windows"])
            return [
                (i, own, sorted(mine, key=lambda s: (s[1], order[s[0]])))
                for i, own, mine in zip(ids, base, spans)
            ]

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(table, [id_col, "base", "found"], make, f"`{id_col}` {kind}, base {SPANS}, spans {SPANS}")
