"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of one to three characters per language, hashed into a fixed number of
buckets, over all training documents; the log-probability matrix (languages x buckets) is broadcast
and batches are scored in numpy. Characters are folded to lower case and everything but letters
counts as a blank.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text
when nothing was learned. Repeated rows are counted and predicted each. Rows with a null id do not
train and are left out. Columns besides doc_id, text and lang are not read.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenloom.llm import textvec as tv
from lumenloom.llm.tables import written

BUCKETS = 1 << 16
CHUNK = 1 << 12
#: The broadcast matrix has 256 KB a language; more languages than this are refused, so 128 MB bound it.
MOST_LANGUAGES = 512
UNKNOWN = "und"
SLICE = 1 << 20


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


def bucketed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every n-gram, the text it is from, and whether each text has a letter."""
    if not texts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    joined = "\0\0\0".join((t or "").lower() for t in texts) + "\0\0\0"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    blank = np.cumsum(code == 0)
    owner = blank // 3
    if blank[-1] != 3 * len(texts):  # a text holds the separator itself
        texts = [t.replace("\0", " ") if t else t for t in texts]
        return bucketed(texts)
    letter = _letters()[code]
    some = np.zeros(len(texts) + 1, dtype=bool)
    some[owner[letter]] = True
    symbol = np.where(letter, code, 32).astype(np.uint64)
    near, out, whose = letter.copy(), [], []
    key = np.zeros(code.size, dtype=np.uint64)
    factors = tv.salts(3, 51)
    for n in range(3):
        size = code.size - n
        key = key[:size] + symbol[n:] * factors[n]
        near = near[:size] | letter[n:]
        # grams that reach into the separator end with the word; those with no letter tell nothing
        at = np.flatnonzero(near & (code[:size] != 0))
        out.append((tv.mix(key[at] + np.uint64(n)) >> np.uint64(48)).astype(np.int64))
        whose.append(owner[at])
    return np.concatenate(out), np.concatenate(whose), some[: len(texts)]


def _trains(doc_id: int | None, modulus: int, held: int) -> bool | None:
    """Whether a document trains; null for one without an id, which does not."""
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus != held


_COUNTS = pa.schema([("lang", pa.string()), ("chunk", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])
_COUNTS_SQL = "lang string, chunk int, part int, counts binary"


def _rows(totals: dict[str, np.ndarray], part: int) -> Iterator[pa.RecordBatch]:
    for lang, counts in totals.items():
        pieces = [c.tobytes() for c in counts.reshape(-1, CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(([lang] * len(pieces), range(len(pieces)), [part] * len(pieces), pieces), _COUNTS)], schema=_COUNTS)


def _count(modulus: int, held: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, totals = TaskContext.get().partitionId() % groups, {}
        for batch in batches:
            for piece in tv.slices(batch, "text", SLICE):
                rows = [(t, lang) for i, t, lang in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "lang"))) if lang is not None and _trains(i, modulus, held)]
                if not rows:
                    continue
                langs = sorted({lang for _, lang in rows})
                bucket, owner, _ = bucketed([t for t, _ in rows])
                which = np.searchsorted(langs, [lang for _, lang in rows])[owner]
                counts = np.bincount(which * BUCKETS + bucket, minlength=len(langs) * BUCKETS).reshape(-1, BUCKETS)
                for lang, row in zip(langs, counts):
                    totals[lang] = totals[lang] + row if lang in totals else row
                if len(totals) > MOST_LANGUAGES:
                    yield from _rows(totals, part)
                    totals = {}
        yield from _rows(totals, part)

    return run


def _add(rows: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(c, dtype=np.int64) for c in rows.column("counts").to_pylist()], axis=0)
    return pa.table([rows.column("lang")[:1], rows.column("chunk")[:1], pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], schema=_COUNTS)


def train(docs: DataFrame, modulus: int, held: int) -> tuple[list[str], np.ndarray]:
    """Languages and the log-probabilities of their n-grams, add-one smoothed."""
    training = docs.where("lang IS NOT NULL")
    groups = max(1, round(docs.rdd.getNumPartitions() ** 0.5))
    counts = training.mapInArrow(_count(modulus, held, groups), _COUNTS_SQL)
    for keys in (("lang", "chunk", "part"), ("lang", "chunk")):
        counts = counts.groupBy(*keys).applyInArrow(_add, _COUNTS_SQL)
    counts = written(counts, "languages")
    langs = [r[0] for r in counts.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    matrix = np.zeros((len(langs), BUCKETS))
    for r in counts.toLocalIterator():
        matrix[langs.index(r["lang"]), r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], dtype=np.int64)
    matrix = np.log(matrix + 1) - np.log(matrix.sum(axis=1, keepdims=True) + BUCKETS)
    return langs, matrix.astype(np.float32)


def identify(docs: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score (posterior of the prediction under a flat prior).

    Documents whose crc32(id) mod ``modulus`` is ``held``, or whose lang is null, do not train.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    langs, matrix = train(docs, modulus, held)
    model = docs.sparkSession.sparkContext.broadcast(matrix)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tv.slices(batch, "text", SLICE):
                ids, texts = (piece.column(c).to_pylist() for c in ("doc_id", "text"))
                bucket, owner, some = bucketed(texts)
                pred, score = [UNKNOWN] * len(ids), np.zeros(len(ids))
                if langs:
                    logs = np.stack([np.bincount(owner, weights=row[bucket], minlength=len(ids)) for row in model.value])
                    best = logs.argmax(axis=0)
                    odds = 1 / np.exp(logs - logs.max(axis=0)).sum(axis=0)
                    pred = [langs[k] if s else UNKNOWN for k, s in zip(best, some)]
                    score = np.where(some, odds, 0.0)
                out = [None if i is None else not _trains(i, modulus, held) for i in ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, out, pred, score), schema)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
