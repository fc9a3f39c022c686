"""Log-probabilities of texts under a smoothed n-gram model, read as a weighted backoff automaton.

The model never exists in one place. Documents are packed into blocks; each block asks for the corpus
counts of the n-grams it holds, once each, and so a very common n-gram costs at most one row per block.
Requests meet in buckets by the top bits of the n-gram's hash; each bucket adds up the training counts
and answers every block that asked. From its answers a block builds the part of the automaton that its
documents can reach: known contexts are states, known n-grams are arcs, and a state without an arc for
the next word fails over to its longest proper suffix. One pass from left to right then scores a text.

Smoothing adds ``prior`` counts spread like the next lower order:
p(w | c) = (count(c w) + prior * p(w | shorter c)) / (count(c) + prior), down to
p(w) = (count(w) + 1) / (N + V + 1). So the failure arc of c weighs prior / (count(c) + prior).

Defined results: a null or empty text has the end token alone. Repeated rows are scored each, and
counted each if they train. Rows with a null id train nothing and are scored; whether they are held out
is null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenloom.llm import textvec as tv
from lumenloom.llm.tables import written

#: n-grams that one bucket adds up, on average: the memory of a task, not of the model.
BUCKET_GRAMS = 1_000_000
BLOCK_BYTES = 4 << 20
#: Requests of one bucket that one task adds up or answers; a bucket that more blocks ask takes two steps.
ASKED = 4_096
_END = tv.salts(1, 99)[0]
#: n-grams of two and more words are told apart by the upper 56 bits of their hash, words by all 64.
_GRAM_BITS = np.uint64(0xFFFFFFFFFFFFFF00)
_LOW = np.uint64(8)

_BLOCK = pa.schema([("block", pa.int64()), ("grams", pa.int64()), ("ids", pa.binary()), ("train", pa.binary()), ("lengths", pa.binary()), ("vocabulary", pa.binary()), ("tokens", pa.binary())])
_BLOCK_SQL = "block long, grams long, ids binary, train binary, lengths binary, vocabulary binary, tokens binary"
_ASK = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("size", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_TELL = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("size", pa.int32()), ("totals", pa.binary()), ("words", pa.int64()), ("tokens", pa.int64())])
_SCORE = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _narrow(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as their largest needs, byte by byte so that equal high bytes
    stand together and compress; the first byte tells the width."""
    x = x.astype("<u8")
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _wide(x: bytes) -> np.ndarray:
    planes = np.frombuffer(x, dtype=np.uint8, offset=1).reshape(x[0], -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, : x[0]] = planes.T
    return out.view("<i8").reshape(-1)


def _keys_of(x: bytes) -> np.ndarray:
    return np.cumsum(_wide(x).view(np.uint64), dtype=np.uint64)


_NAMELESS = 2  # beside 0 for held out and 1 for training


def _pack(modulus: int, held: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in tv.slices(batch, "text", BLOCK_BYTES):
                ids = part.column("doc_id").to_pylist()
                numbers = np.array([0 if i is None else i for i in ids], dtype="<i8")
                words, at = tv.word_hashes(tv.texts_of(part.column("text")), lower=True)
                words = np.insert(words, at[1:], _END)
                vocabulary, tokens, uses = np.unique(words, return_inverse=True, return_counts=True)
                order = np.argsort(-uses, kind="stable")  # frequent words get small numbers
                vocabulary, tokens = vocabulary[order], np.argsort(order)[tokens]
                train = np.array([_NAMELESS if i is None else zlib.crc32(str(i).encode()) % modulus != held for i in ids], dtype=np.uint8)
                grams = words.size * (most - 1) + vocabulary.size
                row = [block, grams, numbers.tobytes(), train.tobytes(), _narrow(np.diff(at) + 1), vocabulary.tobytes(), _narrow(tokens)]
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _BLOCK)], schema=_BLOCK)
                block += 1

    return run


class Block:
    """The n-grams of a packed block. Per order m: distinct keys, sorted, and for each position its key."""

    def __init__(self, row: dict, order: int) -> None:
        self.ids = np.frombuffer(row["ids"], dtype="<i8")
        part = np.frombuffer(row["train"], dtype=np.uint8)
        self.train, self.nameless = part == 1, part == _NAMELESS
        self.lengths, self.tokens = _wide(row["lengths"]), _wide(row["tokens"])
        self.at = np.concatenate([[0], np.cumsum(self.lengths)])
        vocabulary = np.frombuffer(row["vocabulary"], dtype=np.uint64)
        words, owner = vocabulary[self.tokens], np.repeat(np.arange(self.ids.size), self.lengths)
        by_key = np.argsort(vocabulary)
        vocabulary, self.tokens = vocabulary[by_key], np.argsort(by_key)[self.tokens]
        self.keys, self.starts, self.which = [vocabulary], [np.arange(words.size)], [self.tokens]
        for m in range(2, order + 1):
            start = np.flatnonzero(np.arange(words.size) + m <= self.at[1:][owner])
            keys, which = np.unique(tv.gram_hashes(words, m, seed=200 + m)[start] & _GRAM_BITS, return_inverse=True)
            self.keys.append(keys)
            self.starts.append(start)
            self.which.append(which)
        self.trains = [self.train[owner[s]] for s in self.starts]

    def counts(self) -> list[np.ndarray]:
        return [np.bincount(w[t], minlength=k.size) for k, w, t in zip(self.keys, self.which, self.trains)]


def _ask(order: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, out = Block(row := batch.slice(i, 1).to_pylist()[0], order), []
                for m, (keys, counts) in enumerate(zip(block.keys, block.counts()), 1):
                    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
                    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=1 << bits))
                    low = keys if m == 1 else keys >> _LOW
                    for a, b in zip(cuts, cuts[1:]):
                        # sorted, so steps from key to key are small; the first step is from the bucket's start
                        start = np.uint64(int(bucket[a]) << (64 - bits)) >> (_LOW if m > 1 else np.uint64(0))
                        out.append((int(bucket[a]), row["block"], m, _narrow(np.diff(low[a:b], prepend=start)), _narrow(counts[a:b])))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ASK)], schema=_ASK)

    return run


def _added(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys of some requests, their totals, and where the keys of each request are among them."""
    parts = [_keys_of(r["keys"]) for r in rows]
    counts = np.concatenate([_wide(r["counts"]) for r in rows])
    distinct, which = np.unique(np.concatenate(parts), return_inverse=True)
    totals = np.bincount(which, weights=counts, minlength=distinct.size).astype(np.int64)
    return distinct, totals, np.split(which, np.cumsum([p.size for p in parts])[:-1])


def _by_size(asked: pa.Table) -> Iterator[tuple[int, list[dict]]]:
    for m in sorted(set(asked.column("size").to_pylist())):
        yield m, asked.filter(pa.compute.equal(asked.column("size"), m)).to_pylist()


def _tell(asked: pa.Table) -> pa.Table:
    """The training totals of one bucket, in the order in which each block asked for them."""
    out = []
    for m, rows in _by_size(asked):
        _, totals, where = _added(rows)
        first = (int((totals > 0).sum()), int(totals.sum())) if m == 1 else (0, 0)
        for r, at in zip(rows, where):
            out.append((r["block"], r["bucket"], m, _narrow(totals[at]), *first))
            first = (0, 0)
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _TELL)], schema=_TELL)


_SUM = pa.schema([("bucket", pa.int64()), ("size", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_SUM_SQL = "bucket long, size int, keys binary, counts binary"


def _sum(asked: pa.Table) -> pa.Table:
    """Some requests of a bucket as one: its distinct keys and their totals."""
    out = []
    for m, rows in _by_size(asked):
        keys, totals, _ = _added(rows)
        out.append((rows[0]["bucket"], m, _narrow(np.diff(keys, prepend=np.uint64(0))), _narrow(totals)))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _SUM)], schema=_SUM)


def _answer(asked: pa.Table, summed: pa.Table) -> pa.Table:
    """What a part of the blocks asked of a bucket, from the totals of the whole bucket."""
    out, known = [], {r["size"]: r for r in summed.to_pylist()}
    for m, rows in _by_size(asked):
        keys, totals = _keys_of(known[m]["keys"]), _wide(known[m]["counts"])
        first = (int((totals > 0).sum()), int(totals.sum())) if m == 1 and known[m]["slice0"] == 0 else (0, 0)
        for r in rows:
            out.append((r["block"], r["bucket"], m, _narrow(totals[np.searchsorted(keys, _keys_of(r["keys"]))]), *first))
            first = (0, 0)
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _TELL)], schema=_TELL) if out else _TELL.empty_table()


def _told(asked: DataFrame, blocks: int) -> DataFrame:
    """The answers to all requests. A bucket that very many blocks ask is added up in two levels and
    answered in as many parts, so no task holds the requests of a common n-gram from all blocks."""
    schema = "block long, bucket long, size int, totals binary, words long, tokens long"
    slices = -(-blocks // ASKED)
    if slices <= 1:
        return asked.groupBy("bucket").applyInArrow(_tell, schema)
    asked = written(asked.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices))), "asked")
    parts = asked.groupBy("bucket", "slice").applyInArrow(_sum, _SUM_SQL)
    summed = written(parts.groupBy("bucket").applyInArrow(_sum, _SUM_SQL), "bucket-sums")
    here = asked.select("bucket", "slice").distinct()
    first = here.groupBy("bucket").agg(F.min("slice").alias("lowest"))
    # the lowest slice that a bucket has is its slice 0
    here = written(here.join(first, "bucket").select("bucket", "slice", (F.col("slice") - F.col("lowest")).alias("slice0")), "slices")
    return asked.groupBy("bucket", "slice").cogroup(summed.join(here, "bucket").select("bucket", "slice", "size", "keys", "counts", "slice0").groupBy("bucket", "slice")).applyInArrow(_answer, schema)


class Automaton:
    """What a block can reach. State 0 is the empty context; arcs are keyed state * width + token."""

    def __init__(self, block: Block, totals: list[np.ndarray], n: int, v: int, prior: float) -> None:
        order, self.width = len(totals), totals[0].size
        p = [(totals[0] + 1) / (n + v + 1)]
        base = np.concatenate([[1], 1 + np.cumsum([t.size for t in totals])])
        words = np.arange(self.width)
        self.unigram = np.log10(p[0])
        follow = np.where(totals[0] > 0, base[0] + words, 0) if order > 1 else np.zeros_like(words)
        self.arcs = dict(zip(words.tolist(), zip(self.unigram.tolist(), follow.tolist())))
        up, fail = [np.zeros(1 + self.width, dtype=np.int64)], [np.concatenate([[0], prior / (totals[0] + prior)])]
        suffix_state = follow
        for m in range(2, order + 1):
            distinct, first = np.unique(block.which[m - 1], return_index=True)
            start = block.starts[m - 1][first]
            place = np.searchsorted(block.starts[m - 2], start)
            prefix, suffix = block.which[m - 2][place], block.which[m - 2][np.searchsorted(block.starts[m - 2], start + 1)]
            token, count = block.tokens[start + m - 1], totals[m - 1][distinct]
            p.append((count + prior * p[m - 2][suffix]) / (totals[m - 2][prefix] + prior))
            own = np.where(count > 0, base[m - 1] + distinct, 0) if m < order else suffix_state[suffix]
            known = count > 0
            keys = (base[m - 2] + prefix[known]) * self.width + token[known]
            self.arcs.update(zip(keys.tolist(), zip(np.log10(p[-1][known]).tolist(), own[known].tolist())))
            if m < order:
                up.append(suffix_state[suffix])
                fail.append(prior / (totals[m - 1] + prior))
            suffix_state = own
        self.up, self.fail = np.concatenate(up).tolist(), np.log10(np.concatenate(fail), where=np.concatenate(fail) > 0, out=np.zeros(sum(f.size for f in fail))).tolist()

    def score(self, tokens: list[int]) -> float:
        state, total, arcs, width = 0, 0.0, self.arcs, self.width
        for token in tokens:
            arc = arcs.get(state * width + token)
            while arc is None:
                total += self.fail[state]
                state = self.up[state]
                arc = arcs.get(state * width + token)
            total += arc[0]
            state = arc[1]
        return total


def _score(order: int, n: int, v: int, prior: float):
    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        answers = told.sort_by([("size", "ascending"), ("bucket", "ascending")]).to_pylist()
        for i in range(block.num_rows):
            b = Block(block.slice(i, 1).to_pylist()[0], order)
            totals = [np.concatenate([_wide(r["totals"]) for r in answers if r["size"] == m] or [np.empty(0, np.int64)]) for m in range(1, order + 1)]
            automaton = Automaton(b, totals, n, v, prior)
            base = np.add.reduceat(automaton.unigram[b.tokens], b.at[:-1])
            known = np.add.reduceat((totals[0] > 0)[b.tokens].astype(np.int64), b.at[:-1])
            score = [automaton.score(b.tokens[i:j].tolist()) for i, j in zip(b.at, b.at[1:])]
            columns = [pa.array(x, f.type) for x, f in zip((b.ids, ~b.train, b.lengths, known, base, score), _SCORE)]
            for c in (0, 1):  # what has no id has no remainder either
                columns[c] = pa.array(columns[c].to_pylist(), _SCORE[c].type, mask=b.nameless)
            out.append(pa.table(columns, schema=_SCORE))
        return pa.concat_tables(out) if out else _SCORE.empty_table()

    return run


def score_documents(docs: DataFrame, order: int = 2, prior: float = 20.0, modulus: int = 7, held: int = 2) -> DataFrame:
    """Log10 probability of every text; documents whose crc32(id) mod ``modulus`` is ``held`` do not train.

    ``docs`` has doc_id and text. Returns doc_id, held_out, n_tokens (with the end token), n_known,
    train_tokens, base_score (order 1) and score (the automaton of the given order).
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = written(docs.mapInArrow(_pack(modulus, held, order), _BLOCK_SQL), "blocks")
    grams, n_blocks = (x or 0 for x in blocks.agg(F.sum("grams"), F.count("*")).first())
    bits = max(1, int(np.ceil(np.log2(max(1, grams / BUCKET_GRAMS)))))
    asked = blocks.mapInArrow(_ask(order, bits), "bucket long, block long, size int, keys binary, counts binary")
    told = written(_told(asked, n_blocks), "answers")
    n, v = (x or 0 for x in told.agg(F.sum("tokens"), F.sum("words")).first())
    scored = blocks.groupBy("block").cogroup(told.drop("words", "tokens").groupBy("block"))
    scored = scored.applyInArrow(_score(order, n, v, prior), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(n).cast("long"))
