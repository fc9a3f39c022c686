"""Token ids of a corpus, stored as Re-Pair grammars that can be decoded at random.

Documents are sorted by id and cut into shards of about ``SHARD`` ids. In each shard frequent pairs of
symbols are replaced by nonterminals, the most frequent first, until no round gains much. Pairs do not
cross documents, so a document is a slice of the symbols and is decoded alone.

File format: a Parquet table with one row a shard, ordered by (part, number), all arrays little-endian:

* ``n_ids``, ``n_docs``; ``base``: symbols below it are ids;
* ``doc_ids`` int64; a null id is stored as the smallest int64;
* ``lengths`` uint32: ids of each document, end included; ``cuts`` uint32: its symbols;
* ``left``, ``right`` uint32: rule k says that symbol base + k stands for these two;
* ``expansions`` uint32: ids that symbol base + k stands for, so a place among ids is found unexpanded;
* ``symbols`` uint32.

Defined results: a null or empty text is the end id alone. Repeated rows are written each, in the order
of their texts. Null ids come first. Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumenloom.llm import textvec as tv
from lumenloom.llm.encoding import default_path, encoder
from lumenloom.session import shared_dir

SHARD = 1 << 20
END = 0
#: Uses that a pair needs to become a rule, rounds at most, and the share a round has to save.
LEAST, ROUNDS, GAIN = 8, 6, 0.02
_TABLE = 20  # bits of the pair table
_NULL = np.iinfo(np.int64).min

_ARRAYS = ("doc_ids", "lengths", "cuts", "left", "right", "expansions", "symbols")
_SHARD = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("n_ids", pa.int64()), ("n_docs", pa.int64()), ("base", pa.int64()), *((c, pa.binary()) for c in _ARRAYS)])
_SHARD_SQL = "part int, number int, n_ids long, n_docs long, base long, " + ", ".join(f"{c} binary" for c in _ARRAYS)


def _pairs(symbols: np.ndarray, at: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places whose pair is at LEAST of them, ordered by pair; the number of each one's pair; and the pairs in order."""
    bits, low = max(top - 1, 1).bit_length(), max(at.size, 1).bit_length()
    key = symbols[at].astype(np.uint64) << np.uint64(bits) | symbols[at + 1]
    if 2 * bits + low <= 64:  # pair and place sort as one number
        key <<= np.uint64(low)
        key |= np.arange(at.size, dtype=np.uint64)
        key.sort()
        order = (key & np.uint64((1 << low) - 1)).astype(np.int64)
        key >>= np.uint64(low)
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: key.size])
    uses = np.diff(start, append=key.size)
    good = uses >= LEAST
    pairs = key[start[good]]
    which = np.repeat(np.arange(pairs.size), uses[good])
    new = np.stack([pairs >> np.uint64(bits), pairs & np.uint64((1 << bits) - 1)], axis=1).astype(np.uint32)
    return at[order[np.repeat(good, uses)]], which, new


def repair(ids: np.ndarray, lengths: np.ndarray, base: int) -> dict[str, np.ndarray]:
    """The grammar of one shard: left, right, expansions, symbols and cuts."""
    symbols = ids.astype(np.uint32)
    cuts = lengths
    rules, sizes, top = [np.empty((0, 2), np.uint32)], [np.empty(0, np.int64)], base
    size_of = np.empty(0, np.int64)
    for _ in range(ROUNDS):
        if symbols.size < 2:
            break
        spot = symbols[:-1].astype(np.uint64)
        spot <<= np.uint64(32)
        spot |= symbols[1:]
        spot *= np.uint64(0x9E3779B97F4A7C15)
        spot >>= np.uint64(64 - _TABLE)
        spot = spot.view(np.int64)
        spot += 1
        spot[np.cumsum(cuts)[:-1] - 1] = 0
        often = np.bincount(spot, minlength=(1 << _TABLE) + 1).astype(np.uint32)
        often[0] = 0  # places between two documents
        often = often.take(spot)
        # a place is taken if no pair that overlaps it is more frequent; of equal neighbours every other one
        pick = often >= LEAST
        pick[1:] &= often[1:] >= often[:-1]
        pick[:-1] &= often[:-1] >= often[1:]
        at = np.flatnonzero(pick)
        # a pair behind an equally frequent one counts from the start of their run
        change = np.append(True, often[1:] != often[:-1])
        behind, run = np.flatnonzero(~change[at]), np.flatnonzero(change)
        odd = (at[behind] - run[np.searchsorted(run, at[behind], side="right") - 1]) & 1
        at = np.delete(at, behind[odd == 1])
        at, which, new = _pairs(symbols, at, top)
        if at.size < GAIN * symbols.size:
            break
        known = np.concatenate([size_of, np.empty(0, np.int64)])
        part = lambda s: np.where(s < base, 1, known[np.maximum(s.astype(np.int64) - base, 0)] if known.size else 1)
        sizes.append(part(new[:, 0]) + part(new[:, 1]))
        rules.append(new)
        size_of = np.concatenate(sizes)
        symbols[at] = top + which
        keep = np.ones(symbols.size, dtype=bool)
        keep[at + 1] = False
        cuts = np.add.reduceat(keep, np.cumsum(cuts) - cuts, dtype=np.int64)
        symbols = symbols[keep]
        top += len(new)
    both = np.concatenate(rules)
    return {"left": both[:, 0], "right": both[:, 1], "expansions": size_of, "symbols": symbols, "cuts": cuts}


def _step(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, base: int) -> np.ndarray:
    while (big := symbols >= base).any():
        out = np.repeat(symbols, 1 + big)
        at = (np.cumsum(1 + big) - 2)[big]
        rule = symbols[big].astype(np.int64) - base
        out[at], out[at + 1] = left[rule], right[rule]
        symbols = out
    return symbols


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for."""
    if symbols.size <= left.size:
        return _step(symbols, left, right, base)
    # more symbols than rules: each rule is expanded once, and every symbol is a stretch of what they give
    sizes, before = np.ones(base + left.size, np.int64), None
    while before is None or (sizes != before).any():
        before = sizes.copy()
        sizes[base:] = before[left] + before[right]
    given = np.concatenate([np.arange(base, dtype=symbols.dtype), _step(np.arange(base, base + left.size, dtype=symbols.dtype), left, right, base)])
    first = np.cumsum(sizes) - sizes
    size = sizes[symbols]
    shift = first[symbols] - (np.cumsum(size) - size)
    where = np.repeat(shift, size)
    where += np.arange(where.size)
    return given[where]


class Shard:
    """One row of the file; documents and ranges of ids are decoded without the rest."""

    def __init__(self, row: dict) -> None:
        self.base, self.n_ids = row["base"], row["n_ids"]
        self.doc_ids = np.frombuffer(row["doc_ids"], dtype="<i8")
        for c in _ARRAYS[1:]:
            setattr(self, c, np.frombuffer(row[c], dtype="<u4"))
        self.symbol_at = np.concatenate([[0], np.cumsum(self.cuts, dtype=np.int64)])
        self.id_at = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        return expand(symbols, self.left, self.right, self.base)

    def document(self, k: int) -> np.ndarray:
        return self._expand(self.symbols[self.symbol_at[k] : self.symbol_at[k + 1]])

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids from place start to end: only the symbols that reach into the range are expanded."""
        size = np.where(self.symbols < self.base, 1, self.expansions[np.maximum(self.symbols.astype(np.int64) - self.base, 0)] if self.left.size else 1)
        ends = np.cumsum(size)
        first, stop = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, end, side="left") + 1
        before = ends[first - 1] if first else 0
        return self._expand(self.symbols[first:stop])[start - before : end - before]

    def all_ids(self) -> np.ndarray:
        return self._expand(self.symbols)


def _write(path: str):
    def shard(part: int, number: int, docs: list, ids: list, lengths: list, base: int) -> pa.RecordBatch:
        joined, sizes = np.concatenate(ids), np.concatenate(lengths)
        made = repair(joined, sizes, base)
        arrays = {"doc_ids": np.concatenate(docs).astype("<i8"), "lengths": sizes, **made}
        row = [part, number, int(joined.size), int(sizes.size), base, *(arrays[c].astype("<i8" if c == "doc_ids" else "<u4").tobytes() for c in _ARRAYS)]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _SHARD)], schema=_SHARD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, number = encoder(path), TaskContext.get().partitionId(), 0
        docs, ids, lengths, held = [], [], [], 0
        for batch in batches:
            for piece in tv.slices(batch, "text", 4 << 20):
                got, n = tokens.encode(piece.column("text").to_pylist())
                docs.append(piece.column("doc_id").fill_null(_NULL).to_numpy())
                ids.append(np.insert(got, np.cumsum(n), END))
                lengths.append(n + 1)
                held += ids[-1].size
                if held >= SHARD:
                    yield shard(part, number, docs, ids, lengths, tokens.size)
                    docs, ids, lengths, held, number = [], [], [], 0, number + 1
        if docs:
            yield shard(part, number, docs, ids, lengths, tokens.size)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Encode whole texts and write them, each with the end id, in ascending order of doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_write(tokenizer or default_path()), _SHARD_SQL).write.parquet(path)


_DOCS_SQL = "part int, number int, doc_id long, place long, n_tokens long, ids_crc32 long, n_symbols long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            s = Shard(row)
            ids = memoryview(s.all_ids().astype("<u4")).cast("B")
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(s.id_at.tolist(), s.id_at[1:].tolist())]
            n = len(crc)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(n, row["part"]), pa.int32()), "number": pa.array(np.full(n, row["number"]), pa.int32()),
                "doc_id": pa.array(s.doc_ids, mask=s.doc_ids == _NULL), "place": pa.array(s.id_at[:-1]),
                "n_tokens": pa.array(s.lengths.astype(np.int64)), "ids_crc32": pa.array(crc, pa.int64()), "n_symbols": pa.array(s.cuts.astype(np.int64)),
            })


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and n_symbols of every document, decoded from the files."""
    shards = spark.read.schema(_SHARD_SQL).parquet(path)
    # running sums of ids: over parts, then over the shards of a part, so no window holds all shards
    sizes = shards.select("part", "number", "n_ids")
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).withColumn("p", before(Window.partitionBy(F.lit(0)).orderBy("part")))
    sizes = sizes.withColumn("s", before(Window.partitionBy("part").orderBy("number"))).join(parts.select("part", "p"), "part")
    starts = sizes.select("part", "number", (F.col("p") + F.col("s")).alias("first"))
    found = shards.mapInArrow(_digests, _DOCS_SQL).join(starts, ["part", "number"])
    return found.select("doc_id", (F.col("first") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "n_symbols")


def token_output(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the token files into the shared folder and give what is read back from them."""
    path = shared_dir(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer)
    return read_digests(docs.sparkSession, path)
