"""Vectorised words and hashes of a batch of texts, used inside Arrow tasks.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Work goes through buffers of about a megabyte, whatever the size of a text, so that only
eight bytes a word are held beside a text itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_U = np.uint64

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def salts(n: int, seed: int) -> np.ndarray:
    """n odd pseudo-random 64-bit numbers that depend on the seed alone."""
    step = (np.arange(1, n + 1, dtype=_U) + _U(seed * 1_000_003)) * _U(0x9E3779B97F4A7C15)
    return mix(step) | _U(1)


_BYTE = salts(256, 1)
_BASE = 0x2545F4914F6CDD1D
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers.get("up", np.empty(0)).size < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, BLOCK + 1), base, dtype=_U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes, which do not overlap and come in order."""
    out = np.empty(start.size, dtype=_U)
    at = 0
    while at < start.size:
        # about BLOCK bytes at a time, and one stretch at least
        stop = max(at + 1, int(np.searchsorted(end, start[at] + BLOCK, side="right")))
        base, size = start[at], int(end[stop - 1] - start[at])
        up, down = _power_tables(size + 1)
        summed = np.zeros(size + 1, dtype=_U)
        np.cumsum(_BYTE[data[base : base + size]] * up[:size], out=summed[1:])
        a, b = start[at:stop] - base, end[at:stop] - base
        out[at:stop] = mix((summed[b] - summed[a]) * down[a])
        at = stop
    return out


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Groups of whole texts of about BLOCK bytes; a longer text is cut at white space."""
    owners, parts, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while True:
            end = len(text)
            if end - at > BLOCK:
                cut = _SPACE.search(text, at + BLOCK)
                end = cut.start() if cut else end
            owners.append(i)
            parts.append(text[at:end] if at or end < len(text) else text)
            size += end - at + 1
            if size >= BLOCK:
                yield owners, parts
                owners, parts, size = [], [], 0
            if end == len(text):
                break
            at = end
    if parts:
        yield owners, parts


def word_hashes(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and offsets: text i has words offsets[i] to offsets[i + 1].

    A null text has no words. ``lower`` folds A-Z only.
    """
    texts = [t or b"" for t in texts]
    counts, out = np.zeros(len(texts), dtype=np.int64), []
    for owners, parts in _pieces(texts):
        joined = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
        inside = IS_WORD[joined]
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        start, end = edge[::2], edge[1::2]
        up, down = _power_tables(joined.size + 1)
        summed = np.zeros(joined.size + 1, dtype=_U)
        np.cumsum(_BYTE[LOWER[joined] if lower else joined] * up[: joined.size], out=summed[1:])
        out.append(mix((summed[end] - summed[start]) * down[start]))
        ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1)
        upto = np.searchsorted(start, ends)
        np.add.at(counts, np.asarray(owners), np.diff(upto, prepend=0))
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(counts, out=offsets[1:])
    return (np.concatenate(out) if out else np.empty(0, dtype=_U)), offsets


def gram_hashes(words: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """Hashes of every n consecutive entries, also across texts; entry i covers words i to i + n - 1."""
    if words.size < n:
        return np.empty(0, dtype=_U)
    factors = salts(n, seed)
    total = np.zeros(words.size - n + 1, dtype=_U)
    for k in range(n):
        total += words[k : words.size - n + 1 + k] * factors[k]
    return mix(total)


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each entry the text it belongs to."""
    return np.repeat(np.arange(offsets.size - 1), np.diff(offsets))


def shingle_sets(words: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text, sorted; a text of 1 to n - 1 words is one shingle.

    Returns hashes and offsets. Texts without words have no shingle.
    """
    lengths = np.diff(offsets)
    grams = gram_hashes(words, n)
    owner, place = owners(offsets), np.arange(words.size)
    whole = place + n <= offsets[1:][owner]
    short = np.flatnonzero((lengths > 0) & (lengths < n))
    extra = np.empty(short.size, dtype=_U)
    for m in range(1, n):
        rows = np.flatnonzero(lengths[short] == m)
        if rows.size:
            extra[rows] = gram_hashes(words, m, seed=100 + m)[offsets[:-1][short[rows]]]
    value = np.concatenate([grams[np.flatnonzero(whole)], extra])
    whose = np.concatenate([owner[whole], short])
    order = np.lexsort((value, whose))
    value, whose = value[order], whose[order]
    new = np.ones(value.size, dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (whose[1:] != whose[:-1])
    value, whose = value[new], whose[new]
    return value, np.searchsorted(whose, np.arange(lengths.size + 1))


def texts_of(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return column.cast(pa.large_binary()).to_pylist()


def slices(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch cut into slices whose texts have about ``limit`` bytes, so that arrays stay small."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
    bucket = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
