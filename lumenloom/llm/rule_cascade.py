"""Quality rules as a short-circuit cascade.

A rule measures something of each text and rejects by it. Its cost and the share it rejects are
estimated on a sample, the cost from the bytes and words it touches; the cascade then asks rules in the
order of rejections per cost, and a text that one rule rejects is not shown to the next. The verdict is the
conjunction of all rules, so it does not depend on the order, only the time does. Nothing in it
depends on a clock, so the same rows name the same rejecting rules.

Defined results: a null or empty text has no words and fails. Repeated rows are judged each. Columns
besides the text, whatever their names, are carried or ignored, never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenloom.llm import textvec as tv

#: The sample that orders the rules: documents at most, and bytes of each.
SAMPLE, SAMPLE_BYTES = 500, 1 << 16

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[list(b"0123456789")] = True
_LATIN = np.zeros(256, dtype=bool)  # ASCII letters and first bytes of U+00C0 to U+024F
_LATIN[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]] = True
_OTHER = np.zeros(256, dtype=bool)  # first bytes of other scripts, without signs and symbols
_OTHER[[*range(0xCD, 0xE2), *range(0xE3, 0xEE)]] = True
_LETTER = np.zeros(256, dtype=bool)  # ASCII letters and all beyond ASCII
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FIRST = (np.arange(256) & 0xC0) != 0x80  # first bytes of a code point

#: Distinct words are counted in windows of so many words, since their share falls with length.
WINDOW = 1_000

class Texts:
    """Some texts as bytes, with measures that are taken once and shared by rules."""

    def __init__(self, texts: list[bytes | None]) -> None:
        self.texts = [t or b"" for t in texts]
        self._seen: dict[str, np.ndarray] = {}

    def pick(self, rows: np.ndarray) -> Texts:
        part = Texts([self.texts[i] for i in rows])
        part._seen = {k: v[rows] for k, v in self._seen.items() if not k.startswith("_")}
        return part

    def measure(self, name: str) -> np.ndarray:
        if name not in self._seen:
            self._seen[name] = MEASURES[name](self)
        return self._seen[name]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        if "_words" not in self._seen:
            self._seen["_words"] = tv.word_hashes(self.texts)  # type: ignore[assignment]
        return self._seen["_words"]  # type: ignore[return-value]


def _count(table: np.ndarray) -> Callable[[Texts], np.ndarray]:
    def run(x: Texts) -> np.ndarray:
        return np.array([int(np.count_nonzero(table[np.frombuffer(t, dtype=np.uint8)])) for t in x.texts], dtype=np.int64)

    return run


def _dup_lines(x: Texts) -> np.ndarray:
    out = np.zeros(len(x.texts), dtype=np.int64)
    for i, t in enumerate(x.texts):
        if b"\n" in t:
            lines = [line for line in t.split(b"\n") if line.strip(b" \t\n\v\f\r")]
            out[i] = len(lines) - len(set(lines))
    return out


def _repeat_words(x: Texts, n: int = 8) -> np.ndarray:
    words, at = x.words()
    hit = np.zeros(words.size + 1, dtype=np.int64)
    owner = tv.owners(at)
    start = np.flatnonzero(np.arange(words.size) + n <= at[1:][owner]) if words.size else np.empty(0, np.int64)
    if start.size:
        grams = tv.gram_hashes(words, n)[start]
        order = np.lexsort((grams, owner[start]))
        g, o = grams[order], owner[start][order]
        same = (g[1:] == g[:-1]) & (o[1:] == o[:-1])
        twice = np.zeros(g.size, dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        found = start[order[twice]]
        np.add.at(hit, found, 1)
        np.add.at(hit, found + n, -1)
    covered = np.cumsum(hit[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(x.texts)).astype(np.int64)


def _window_distinct(x: Texts) -> np.ndarray:
    """Distinct words of the median window: whole windows from the start and one that ends the text."""
    words, at = x.words()
    size = np.diff(at)
    starts = [np.unique(np.append(np.arange(0, n - WINDOW + 1, WINDOW), max(0, n - WINDOW))) for n in size]
    many = np.array([s.size for s in starts], dtype=np.int64)
    first = np.concatenate([np.empty(0, np.int64), *(a + s for a, s in zip(at, starts))])
    wide = np.repeat(np.minimum(size, WINDOW), many)
    owner = np.repeat(np.arange(first.size), wide)
    place = np.arange(owner.size) - (np.cumsum(wide) - wide)[owner] + first[owner]
    picked = words[place.astype(np.int64)]
    order = np.lexsort((picked, owner))
    w, o = picked[order], owner[order]
    new = np.ones(w.size, dtype=bool)
    new[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
    found = np.split(np.bincount(o[new], minlength=first.size), np.cumsum(many)[:-1]) if many.size else []
    return np.array([np.sort(f)[f.size // 2] for f in found], dtype=np.int64)


def _bare_words(x: Texts) -> np.ndarray:
    """Words without any letter, of whatever script."""
    out = np.zeros(len(x.texts), dtype=np.int64)
    for i, t in enumerate(x.texts):
        data = np.frombuffer(t, dtype=np.uint8)
        edge = np.flatnonzero(np.diff(tv.IS_WORD[data], prepend=False, append=False))
        letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
        out[i] = np.count_nonzero(letters[edge[1::2]] == letters[edge[::2]])
    return out


_WORD_FIRST = _FIRST & tv.IS_WORD
MEASURES: dict[str, Callable[[Texts], np.ndarray]] = {
    "n_words": lambda x: np.diff(x.words()[1]),
    "word_chars": _count(_WORD_FIRST),
    "n_symbols": _count(_SYMBOL),
    "n_digits": _count(_DIGIT),
    "n_lines": lambda x: np.array([t.count(b"\n") + 1 for t in x.texts], dtype=np.int64),
    "n_dup_lines": _dup_lines,
    "n_repeat_words": _repeat_words,
    "n_window_distinct": _window_distinct,
    "n_latin": _count(_LATIN),
    "n_other": _count(_OTHER),
    "n_bare_words": _bare_words,
}
#: What a measure costs, in nanoseconds a byte and a word; ``words`` is what all measures of words share.
COSTS = {
    "words": (6.0, 10.0), "n_words": (0.0, 0.1), "word_chars": (1.0, 0.0), "n_symbols": (1.0, 0.0), "n_digits": (1.0, 0.0), "n_lines": (0.1, 0.0),
    "n_dup_lines": (1.0, 0.0), "n_repeat_words": (0.0, 150.0), "n_window_distinct": (0.0, 120.0), "n_latin": (1.0, 0.0), "n_other": (1.0, 0.0), "n_bare_words": (8.0, 2.0),
}
_OF_WORDS = ("n_words", "n_repeat_words", "n_window_distinct")


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Texts], np.ndarray]
    measures: tuple[str, ...] = ()


def _m(x: Texts, *names: str) -> list[np.ndarray]:
    return [x.measure(n) for n in names]


def _rule(name: str, *names: str):
    return lambda test: Rule(name, lambda x: test(*_m(x, *names)), names)


#: Rejects texts too short, or mostly repeated passages.
BASE = [
    _rule("few_words", "n_words")(lambda w: w < 20),
    _rule("repeated_passages", "n_words", "n_repeat_words")(lambda w, r: 100 * r > 30 * w),
]
#: Further rules, wide enough that running prose of any language passes; the one on the length of words
#: holds for texts in Latin script only.
RULES = [
    _rule("word_length", "n_words", "word_chars", "n_latin", "n_other")(lambda w, c, a, b: (a >= b) & ((c < 2 * w) | (c > 15 * w))),
    _rule("symbols", "word_chars", "n_symbols")(lambda c, s: 10 * s > c),
    _rule("digits", "word_chars", "n_digits")(lambda c, d: 10 * d > 3 * c),
    _rule("repeated_lines", "n_lines", "n_dup_lines")(lambda n, d: (d >= 3) & (10 * d > 3 * n)),
    _rule("few_distinct_words", "n_words", "n_window_distinct")(lambda w, d: (w >= 50) & (100 * d < 8 * np.minimum(w, WINDOW))),
    _rule("words_without_letters", "n_words", "n_bare_words")(lambda w, b: (w >= 50) & (10 * b > 3 * w)),
]


def estimate(texts: list[bytes | None], rules: list[Rule], measured: tuple[str, ...] = ()) -> dict[str, tuple[float, float]]:
    """Cost and share rejected of each rule, on texts whose ``measured`` values are at hand.

    The cost is counted in bytes and words, at what a measure takes of either, so it is the same every time.
    """
    x = Texts(texts)
    size, words = sum(map(len, x.texts)), int(x.measure("n_words").sum())
    has_words = any(m in _OF_WORDS for m in measured)
    found = {}
    for rule in rules:
        parts = [m for m in rule.measures if m not in measured]
        parts += ["words"] if not has_words and any(m in _OF_WORDS for m in parts) else []
        cost = sum(COSTS[m][0] * size + COSTS[m][1] * words for m in parts)
        found[rule.name] = (cost / max(1, len(texts)), float(rule.rejects(x).mean()) if len(texts) else 0.0)
    return found


def ordered(rules: list[Rule], estimates: dict[str, tuple[float, float]]) -> list[Rule]:
    """Most rejections per cost first; rules that reject nothing come last, the cheapest first."""
    return sorted(rules, key=lambda r: (-estimates[r.name][1] / max(estimates[r.name][0], 1e-9), estimates[r.name][0], r.name))


def cascade(x: Texts, rules: list[Rule]) -> np.ndarray:
    """For each text the place of the rule that rejected it, or -1."""
    verdict, left = np.full(len(x.texts), -1, dtype=np.int64), np.arange(len(x.texts))
    for k, rule in enumerate(rules):
        bad = rule.rejects(x)
        verdict[left[bad]] = k
        if bad.any():
            left, x = left[~bad], x.pick(np.flatnonzero(~bad))
        if not left.size:
            break
    return verdict


def plan(docs: DataFrame, rules: list[Rule], measured: tuple[str, ...] = ()) -> list[Rule]:
    """The rules in the order that a sample asks for: the first documents, of which few parts are read."""
    few = docs.select("text").where(F.octet_length("text") <= SAMPLE_BYTES).limit(SAMPLE).collect()
    return ordered(rules, estimate([r[0].encode() for r in few], rules, measured))


_REPORT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id with all base measures, base_failed, kept and the rule that rejected the text, if any."""
    rules = plan(docs, RULES, _REPORT)
    names = [r.name for r in rules] + [None]
    schema = pa.schema([("doc_id", pa.int64()), *((m, pa.int64()) for m in _REPORT), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("rejected_by", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.slices(batch, "text", 2 << 20):
                x = Texts(tv.texts_of(part.column("text")))
                measures = _m(x, *_REPORT)
                failed = np.zeros(part.num_rows, dtype=bool)
                by = np.full(part.num_rows, None, dtype=object)
                for rule in BASE:
                    bad = rule.rejects(x) & ~failed
                    by[bad] = rule.name
                    failed |= bad
                rest = np.flatnonzero(~failed)
                found = cascade(x.pick(rest), rules)
                by[rest] = np.array(names, dtype=object)[found]
                kept = pa.array(by == None, pa.bool_())  # noqa: E711
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(m, pa.int64()) for m in measures), pa.array(failed), kept, pa.array(by.tolist(), pa.string())], schema=schema)

    out = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, out)


def passing(docs: DataFrame) -> DataFrame:
    """The rows whose text passes every rule, with all their columns."""
    rules = plan(docs, [*BASE, *RULES])
    text = [f.name for f in docs.schema].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.slices(batch, batch.schema.names[text], 2 << 20):
                found = cascade(Texts(tv.texts_of(part.column(text))), rules)
                yield part.filter(pa.array(found < 0))

    return docs.mapInArrow(run, docs.schema)
