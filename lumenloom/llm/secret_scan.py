"""Secrets by fixed patterns and by a character convolutional network over further candidates.

Patterns give the base findings. Candidates are runs of token characters that hold a digit, change case
inside, or are long. The network reads a whole candidate, however long, with the characters before and
after it. It learns from labelled findings: a candidate in a base finding is a secret; outside of them
numbers, UUIDs, dates, host names, paths, slugs and plain words are none; others have no label and are
only scored. It is calibrated on a part of the findings it has not seen, and its threshold is the highest that
still finds ``RECALL`` of that part's secrets. Candidates above the threshold that base findings do not
cover are added; base findings always stay.

The network learns from every labelled finding there is, each window once and a run of more than ``PIECE``
characters in pieces. ``PRIOR`` made examples of either label are among the findings, so that a corpus with few
or none has a network too. A round sends the network to buckets of findings, dealt by hash, each learns on, and
Spark averages what they have learned, and Adam's moments, by their sizes. Every fourth
finding by hash is held out: calibration and threshold come from all of these. Every candidate of every text is
scored.

Defined results: a null or empty text has no findings. Repeated rows are scanned each. Columns besides
doc_id and text are not read.
"""

from __future__ import annotations

import copy
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenloom.llm import textvec as tv
from lumenloom.llm.tables import written

PRIOR = 300
#: Findings of a bucket, and their characters at most, roughly.
BUCKET, BUCKET_CHARS = 4_096, 1 << 20
#: Rounds of learning between which buckets are averaged, and how often a bucket reads its findings in each.
ROUNDS, READINGS = 5, 3
RECALL = 0.99
BEFORE, AFTER = 16, 4
SHORT = 16
#: Characters of a candidate that are read at once; the responses to all pieces of a longer one are pooled.
PIECE = 4_096
#: Characters read in one step over many candidates.
STEP = 1 << 16

# Fixed patterns, with the length that a match or its value needs.
KINDS = ("assign", "access", "hex", "network")
_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]*[A-Za-z0-9+/_=-]")
LEAST, LONG = 8, 20
_DIGIT, _TURN = re.compile(r"[0-9]"), re.compile(r"[a-z][A-Z]")
# What is no secret: numbers, UUIDs, dates, and words, with up to four digits behind, between signs.
_WORD = "([A-Z]?[a-z]+|[A-Z]+)?[0-9]{0,4}"
_NONE = re.compile(
    r"[^A-Za-z]*|[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[0-9]{4}-[0-9]{2}-[0-9]{2}[T_][0-9:.-]*Z?"
    rf"|{_WORD}([-+/_=.]{_WORD})*"
)

Span = tuple[int, int, int]  # start, place of the kind, end


def base_spans(text: str) -> list[Span]:
    """Findings of the patterns by start, then kind. A match that is too short is dropped."""
    out: list[Span] = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    """Start and end of runs that could be secrets."""
    out = []
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        if b - a >= LEAST and (b - a >= LONG or _DIGIT.search(text, a, b) or _TURN.search(text, a, b)):
            out.append((a, b))
    return out


def is_none(run: str) -> bool:
    """Whether a candidate outside of base findings is known to be no secret."""
    return bool(_NONE.fullmatch(run))


def _kind(a: int, b: int, spans: list[Span]) -> int | None:
    """The kind of the first base finding that a candidate meets."""
    return next((k for s, k, e in spans if s < b and a < e), None)


def _covered(a: int, b: int, spans: list[Span]) -> bool:
    """Whether base findings hold all of a candidate."""
    for s, _, e in spans:
        if s <= a < e:
            a = e
    return a >= b


def _window(text: str, a: int, b: int) -> str:
    """The candidate between fixed widths of what stands before and after."""
    return text[max(0, a - BEFORE) : a].rjust(BEFORE) + text[a:b] + text[b : b + AFTER].ljust(AFTER)


def _codes(window: str) -> np.ndarray:
    """Classes of characters: digits, letters apart by case and hexadecimal use, signs each on their own."""
    code = np.frombuffer(window.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return _CLASS[np.minimum(code, 127)]


_CLASS = np.zeros(128, dtype=np.uint8)
for _k, _group in enumerate(["0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", " ", "\0", *"\"'=:.,-_/+|@()\n"], 1):
    for _c in _group:
        _CLASS[ord(_c)] = _k
_CLASSES = int(_CLASS.max()) + 1


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


class Network:
    """Embedding, one convolution, the largest and mean response of each filter over a candidate of any length, a logistic unit."""

    def __init__(self, seed: int = 5, embed: int = 8, filters: int = 16, reach: int = 5) -> None:
        r = np.random.default_rng(seed)
        self.reach = reach
        self.p = {
            "embed": r.normal(0, 0.3, (_CLASSES, embed)),
            "conv": r.normal(0, 0.3, (reach * embed, filters)),
            "bias": np.zeros(filters),
            "out": r.normal(0, 0.1, 2 * filters),
            "shift": np.zeros(1),
        }
        self.moments = {k: np.zeros((2, *v.shape)) for k, v in self.p.items()}
        self.steps = 0
        self.scale = np.array([1.0, 0.0])

    def _responses(self, rows: list[np.ndarray]):
        """Places of the filters over all rows behind each other: classes, responses, and where each row begins."""
        x = np.concatenate(rows)
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        ends = np.cumsum(size)
        # a filter stands inside one row
        at = np.arange(x.size)
        at = at[at + self.reach <= np.repeat(ends, size)]
        n = size - self.reach + 1
        start = np.cumsum(n) - n
        views = x[at[:, None] + np.arange(self.reach)]
        w = self.p["embed"][views].reshape(at.size, -1)
        return views, w, np.maximum(w @ self.p["conv"] + self.p["bias"], 0), start, n

    def _unit(self, top: np.ndarray, mean: np.ndarray) -> np.ndarray:
        return np.concatenate([top, mean], axis=1) @ self.p["out"] + self.p["shift"][0]

    def logit(self, rows: list[np.ndarray]) -> np.ndarray:
        """One number per row; long rows are read in pieces, and many rows in steps."""
        n, f = len(rows), self.p["bias"].size
        top, total, count = np.zeros((n, f)), np.zeros((n, f)), np.zeros(n)
        parts: list[tuple[int, np.ndarray]] = []
        size = 0

        def step() -> None:
            if parts:
                owner = np.array([i for i, _ in parts])
                _, _, h, start, places = self._responses([x for _, x in parts])
                np.maximum.at(top, owner, np.maximum.reduceat(h, start))
                np.add.at(total, owner, np.add.reduceat(h, start))
                np.add.at(count, owner, places)

        for i, row in enumerate(rows):
            for at in range(0, max(1, len(row) - self.reach + 1), PIECE):
                parts.append((i, row[at : at + PIECE + self.reach - 1]))
                size += len(parts[-1][1])
                if size >= STEP:
                    step()
                    parts, size = [], 0
        step()
        return self._unit(top, total / np.maximum(count, 1)[:, None])

    def probability(self, rows: list[np.ndarray]) -> np.ndarray:
        return _sigmoid(self.scale[0] * self.logit(rows) + self.scale[1])

    def fit(self, rows: list[np.ndarray], y: np.ndarray, share: float, rounds: int = 15, batch: int = 64, rate: float = 0.01) -> None:
        """Adam over the rows; ``share`` of all there are, here or not, have the label 1. A step has ``batch`` rows or STEP characters."""
        r = np.random.default_rng(6 + self.steps)
        weight = np.where(y == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        for _ in range(rounds):
            order = r.permutation(len(y))
            stop = np.flatnonzero((np.diff(np.cumsum(size[order]) // STEP) > 0) | (np.arange(1, len(y)) % batch == 0)) + 1
            for some in np.split(order, stop):
                views, w, h, start, n = self._responses([rows[i] for i in some])
                top, mean = np.maximum.reduceat(h, start), np.add.reduceat(h, start) / n[:, None]
                d = (_sigmoid(self._unit(top, mean)) - y[some]) * weight[some] / len(some)
                f, owner = h.shape[1], np.repeat(np.arange(len(some)), n)
                dp = d[:, None] * self.p["out"]
                dh = (dp[:, f:] / n[:, None])[owner]
                # the first place of the largest response of each row and filter
                place, which = np.nonzero(h == top[owner])
                _, first = np.unique(owner[place] * f + which, return_index=True)
                dh[place[first], which[first]] += dp[owner[place[first]], which[first]]
                dh *= h > 0
                dw = (dh @ self.p["conv"].T).reshape(len(views), self.reach, -1)
                g = {"out": np.concatenate([top, mean], axis=1).T @ d, "shift": d.sum(keepdims=True), "conv": w.T @ dh, "bias": dh.sum(0), "embed": np.zeros_like(self.p["embed"])}
                np.add.at(g["embed"], views, dw)
                self.steps += 1
                for k, (m, v) in self.moments.items():
                    m += 0.1 * (g[k] - m)
                    v += 0.001 * (g[k] ** 2 - v)
                    self.p[k] -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)

    def flat(self) -> np.ndarray:
        """All that is learned, in one row: steps, weights and their moments."""
        return np.concatenate([[self.steps], *(v.ravel() for part in (self.p, self.moments) for v in part.values())])

    def take(self, flat: np.ndarray) -> None:
        self.steps, at = max(1, round(flat[0])), 1
        for part in (self.p, self.moments):
            for k, v in part.items():
                part[k] = flat[at : at + v.size].reshape(v.shape).copy()
                at += v.size


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of all labelled candidates (0: none, else one more than the place of their kind), long ones in pieces."""
    for batch in batches:
        found: set[tuple[str, int]] = set()
        for text in batch.column("text").to_pylist():
            if not text or not (spans := candidates(text)):
                continue
            base = base_spans(text)
            for a, b in spans:
                kind = _kind(a, b, base)
                if kind is not None or is_none(text[a:b]):
                    found |= {(_window(text, at, min(at + PIECE, b)), 0 if kind is None else kind + 1) for at in range(a, b, PIECE)}
        yield pa.RecordBatch.from_pydict({"window": pa.array([w for w, _ in found], pa.string()), "label": pa.array([y for _, y in found], pa.int32())})


@functools.cache
def made_examples() -> tuple[list[str], list[str]]:
    """PRIOR windows of secrets and of none, the same ones every time."""
    r = np.random.default_rng(11)
    some = lambda letters, low, high: "".join(r.choice(list(letters), r.integers(low, high)))
    hexa, digits = "0123456789abcdef", "0123456789"
    low = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(some("bcdfghklmnprstvw", 1, 2) + some("aeiou", 1, 2) for _ in range(r.integers(1, 5)))
    secret = [
        lambda: some(hexa, 16, 64), lambda: some(low + low.upper() + digits, 16, 48), lambda: some(low + low.upper() + digits + "+/", 20, 60) + "=",
        lambda: some(low.upper() + digits, 16, 32), lambda: some(low + digits, 14, 40), lambda: f"{some(low, 2, 4)}_{some(low + low.upper() + digits, 20, 40)}",
        lambda: some(low + low.upper() + digits + "-_", 20, 50), lambda: f"{some(hexa, 8, 40)}-{some(hexa, 0, 12)}",
    ]
    none = [
        lambda: some(digits, 8, 20), lambda: f"{some(digits, 3, 4)}-{some(digits, 4, 9)}", lambda: ".".join(some(digits, 1, 4) for _ in range(4)),
        lambda: "-".join(some(hexa, n, n + 1) for n in (8, 4, 4, 4, 12)), lambda: f"{some('12', 1, 2)}0{some(digits, 2, 3)}-0{some('123456789', 1, 2)}-1{some(digits, 1, 2)}",
        lambda: f"{word()}{some(digits, 1, 3)}.{word()}.com", lambda: "/".join(word() for _ in range(r.integers(3, 6))), lambda: "-".join(word() for _ in range(r.integers(2, 6))),
        lambda: word() + word() + some(digits, 1, 4), lambda: word() + word().capitalize() + word().capitalize(), lambda: word() * 4, lambda: f"{word()}_{word()}={some(digits, 1, 5)}",
    ]
    around = [("key = \"", '"'), ("token: ", ","), ("", ""), (f"{word()} {word()} ", f" {word()}"), ("(", ")"), ("see ", ".")]

    def windows(makers: list) -> list[str]:
        out = []
        for i in range(PRIOR):
            before, after = around[r.integers(len(around))]
            run = makers[i % len(makers)]()
            out.append(_window(before + run + after, len(before), len(before) + len(run)))
        return out

    return windows(secret), windows(none)


def _views(window: str) -> list[np.ndarray]:
    """A window, the same without what stands around it, and once more cut short, so that the candidate
    itself is learned, whatever its length."""
    run = window[BEFORE:-AFTER]
    return [_codes(w) for w in (window, " " * BEFORE + run + " " * AFTER, " " * BEFORE + run[:SHORT] + " " * AFTER)]


#: The labels of made runs that are none and of made secrets.
MADE_NONE, MADE_SECRET = -1, len(KINDS) + 1


def findings(docs: DataFrame) -> DataFrame:
    """Every labelled window of the texts and the made ones, once: window, label (above 0: a secret), h (its hash)."""
    secret, none = made_examples()
    made = docs.sparkSession.createDataFrame([*((w, MADE_NONE) for w in none), *((w, MADE_SECRET) for w in secret)], "window string, label int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _labelled(part for batch in batches for part in tv.slices(batch, "text"))

    found = docs.select("text").mapInArrow(run, "window string, label int").unionByName(made).distinct()
    return written(found.withColumn("h", F.xxhash64("window")), "findings")


def _learned(net: Network, share: float):
    """What a bucket makes of the network, times its findings, by place."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("window", "ascending"), ("label", "ascending")])
        here, n = copy.deepcopy(net), table.num_rows
        rows = [v for w in table["window"].to_pylist() for v in _views(w)]
        here.fit(rows, np.repeat((table["label"].to_numpy() > 0).astype(float), 3), share, READINGS)
        flat = here.flat()
        return pa.table({"place": pa.array(np.arange(flat.size), pa.int32()), "value": pa.array(flat * n, pa.float64())})

    return run


def _scored(found: DataFrame, net: Network, every_view: bool) -> DataFrame:
    """label and logit z of windows, of all their views or as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, windows = batch.column("label").to_numpy(), batch.column("window").to_pylist()
            for at in range(0, len(windows), 256):
                views = [_views(w) if every_view else [_codes(w)] for w in windows[at : at + 256]]
                z = net.logit([v for some in views for v in some])
                yield pa.RecordBatch.from_pydict({"label": pa.array(np.repeat(labels[at : at + 256], len(views[0])), pa.int32()), "z": pa.array(z, pa.float64())})

    return found.select("window", "label").mapInArrow(run, "label int, z double")


def _exact(x: Column) -> Column:
    """A sum that does not depend on the order of its rows."""
    return F.sum(x.cast("decimal(38,15)")).cast("double")


def _probability(scale: np.ndarray) -> Column:
    z = F.greatest(F.lit(-60.0), F.least(F.lit(60.0), F.lit(float(scale[0])) * F.col("z") + F.lit(float(scale[1]))))
    return 1 / (1 + F.exp(-z))


def _calibration(rows: DataFrame) -> np.ndarray:
    """Slope and shift of the logit that make held-out probabilities right (Platt's targets), by Newton steps over all rows."""
    up, of = rows.agg(F.count(F.when(F.col("label") > 0, 1)), F.count("*")).first()
    goal = F.when(F.col("label") > 0, (up + 1) / (up + 2)).otherwise(1 / (of - up + 2))
    a, z = np.array([1.0, 0.0]), F.col("z")
    for _ in range(100):
        q = _probability(a)
        d, s = q - goal, q * (1 - q)
        gz, g, hzz, hz, h = rows.agg(*map(_exact, (d * z, d, s * z * z, s * z, s))).first()
        step = np.clip(np.linalg.solve(np.array([[hzz, hz], [hz, h]]) + np.eye(2), np.array([gz, g]) + a - [1.0, 0.0]), -0.5, 0.5)
        a = a - step
        if np.abs(step).max() < 1e-9:
            break
    return a


def fitted(found: DataFrame) -> tuple[Network, float]:
    """The calibrated network and its threshold, from all findings (window, label, h)."""
    held = F.pmod("h", F.lit(4)) == 3
    net = Network()
    n, secret, chars = found.where(~held).agg(F.count("*"), F.count(F.when(F.col("label") > 0, 1)), F.sum(F.length("window"))).first()
    buckets = max(-(-n // BUCKET), -(-chars // BUCKET_CHARS))
    dealt = found.where(~held).select("window", "label", F.pmod(F.shiftright("h", 2), F.lit(buckets)).alias("bucket")).repartition(buckets, "bucket")
    for _ in range(ROUNDS):
        parts = dealt.groupBy("bucket").applyInArrow(_learned(net, secret / n), "place int, value double")
        net.take(np.array([r["value"] for r in parts.groupBy("place").agg(_exact(F.col("value")).alias("value")).orderBy("place").collect()]) / n)
    rows = written(_scored(found.where(held), net, True), "held-out")
    net.scale = _calibration(rows)
    rows = rows.select((F.col("label") > 0).alias("secret"), _probability(net.scale).alias("p"))
    secrets = rows.where("secret")
    least = secrets.orderBy("p").limit(int((1 - RECALL) * secrets.count()) + 1).agg(F.max("p")).first()[0]
    # half way to the next score below, so that a gap between both labels is cut in its middle
    below = rows.where(F.col("p") < least).agg(F.max("p")).first()[0]
    return net, (least + (below or 0.0)) / 2


def held_out_recall(docs: DataFrame, kind: str) -> tuple[int, int, int, int]:
    """How the network does where no pattern helps: secrets of ``kind`` found and in all, by a network that has
    seen none of them, and labelled runs that are none taken for secrets, and in all."""
    found, label = findings(docs), KINDS.index(kind) + 1
    net, least = fitted(found.where(F.col("label") != label))
    scored = _scored(found.where(F.col("label").isin(0, label)), net, False)
    hit = {r["label"]: (r["hit"], r["n"]) for r in scored.groupBy("label").agg(F.count(F.when(_probability(net.scale) >= least, 1)).alias("hit"), F.count("*").alias("n")).collect()}
    return *hit.get(label, (0, 0)), *hit.get(0, (0, 0))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_network and n_scored of every document.

    ``n_network`` counts the spans that the network adds, ``n_scored`` the candidates it has judged.
    """
    net, least = fitted(findings(docs))
    numbers = ("n_assign", "n_access", "n_hex")
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in numbers), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_network", pa.int64()), ("n_scored", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, more = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                base.append(base_spans(text) if text else [])
                if text:
                    more += [(k, a, b, _codes(_window(text, a, b))) for a, b in candidates(text) if not _covered(a, b, base[-1])]
            spans, scored = [list(s) for s in base], [0] * batch.num_rows
            for at in range(0, len(more), 4096):
                part = more[at : at + 4096]
                for (k, a, b, _), p in zip(part, net.probability([m[3] for m in part])):
                    scored[k] += 1
                    if p >= least:
                        spans[k].append((a, 3, b))
            count = [[sum(s[1] == k for s in row) for row in spans] for k in range(4)]
            sha = [hashlib.sha256(_joined(row).encode()).hexdigest() for row in base]
            rows = [batch.column("doc_id"), *count[:3], sha, [_joined(sorted(row)) for row in spans], count[3], scored]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(rows, schema)], schema=schema)

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(part for batch in batches for part in tv.slices(batch, "text"))

    out = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_network long, n_scored long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sliced, out)
