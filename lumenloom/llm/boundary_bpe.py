"""Byte-level BPE by a tree reduction: halves are encoded on their own and joined at their boundary.

Encodings are a monoid. A text is cut in halves, down to leaves; two neighbours are joined by encoding
anew a window of tokens around their boundary, which grows until its first and last token are what they
were. From there on nothing can change: an id sequence is the encoding of its bytes exactly if each two
adjacent ids are the encoding of their bytes, the pairs outside the window are those of the halves, and
the pairs inside come from one encoding. That holds where every rank is reached by merges of lower ranks,
which ``Ranks`` checks. Where no match of the pattern can reach over a cut (before a blank between two
characters that are no white space) halves need no window at all; so texts are cut there first, and the
windows serve inside the matches of the pattern. Decoding concatenates up the same tree.

Matches repeat, so a worker remembers the ids of each. Defined results: a null text is the empty text and
has no ids; null ids decode to no bytes. Repeated rows and null document ids are rows like any other.
Columns besides text (or ids) are carried along, whatever their names, but those the results are named for.
"""

from __future__ import annotations

import base64
import functools
import heapq
from array import array
from collections.abc import Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from lumenloom.llm import textvec as tv

#: Characters of a text that are matched at once, and bytes of a match that are merged at once.
LEAF_TEXT, LEAF_BYTES = 1 << 16, 16
#: Bytes merged by looking at all pairs each time; more need a heap.
FEW_BYTES, NEVER = 64, 1 << 40
#: Ids decoded at once.
LEAF_IDS = 1 << 18
#: Matches whose ids a worker remembers; afterwards it starts anew.
REMEMBERED = 1_000_000
#: Before this blank every match has ended and a new one starts.
_CUT = regex.compile(r"(?<=\S) (?=\S)")


def _stretches(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The entries from each start to its end, behind each other."""
    size = end - start
    ends = np.cumsum(size)
    return values[np.arange(int(ends[-1]) if ends.size else 0) + np.repeat(start - (ends - size), size)]


class Ranks:
    """Encoding and decoding by the ranks of a file: one base64 token and its rank a line."""

    def __init__(self, lines: bytes, pattern: str) -> None:
        pairs = (line.split() for line in lines.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.pattern = regex.compile(pattern)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        size = max(self.tokens, default=-1) + 1
        sizes = [len(self.tokens.get(k, b"")) for k in range(size)]
        self.bytes = np.frombuffer(b"".join(self.tokens.get(k, b"") for k in range(size)), dtype=np.uint8)
        self.at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        odd = next((t for t, k in self.ranks.items() if self.merged(t) != [k]), None)
        if odd is not None:
            raise ValueError(f"rank of {odd!r} is not reached by merges, so halves cannot be joined")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        # grow in place; numpy reads them for the length of a statement only
        self.flat, self.starts = array("i"), array("q", [0])

    def merged(self, data: bytes) -> list[int]:
        """The ids of bytes: the lowest rank merges first, the leftmost of equal ones."""
        n, ranks = len(data), self.ranks
        if n <= FEW_BYTES:
            get, at = ranks.get, list(range(n + 1))
            pairs = [get(data[i : i + 2], NEVER) for i in range(n - 1)]
            while pairs and (least := min(pairs)) < NEVER:
                i = pairs.index(least)
                del at[i + 1], pairs[i]
                if i < len(pairs):
                    pairs[i] = get(data[at[i] : at[i + 2]], NEVER)
                if i:
                    pairs[i - 1] = get(data[at[i - 1] : at[i + 1]], NEVER)
            return [ranks[data[a:b]] for a, b in pairwise(at)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(ranks[data[i : i + 2]], i, i + 2) for i in range(n - 1) if data[i : i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or after[j] != end:
                continue  # one of the two has merged with another since
            alive[j] = False
            after[i] = end
            if end < n:
                before[end] = i
                wider = ranks.get(data[i : after[end]])
                if wider is not None:
                    heapq.heappush(heap, (wider, i, after[end]))
            if before[i] >= 0:
                wider = ranks.get(data[before[i] : end])
                if wider is not None:
                    heapq.heappush(heap, (wider, before[i], end))
        return [ranks[data[i : after[i]]] for i in range(n) if alive[i]]

    def _bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The ids of the bytes of two encodings behind each other."""
        if not left or not right:
            return left or right
        a = b = 1
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            window = self.merged(self._bytes_of(left[-a:]) + self._bytes_of(right[:b]))
            stable_left = a == len(left) or window[0] == left[-a]
            stable_right = b == len(right) or window[-1] == right[b - 1]
            if stable_left and stable_right:
                return left[: len(left) - a] + window + right[b:]
            a, b = (a if stable_left else 2 * a), (b if stable_right else 2 * b)

    def encoded(self, data: bytes) -> list[int]:
        """The ids of the bytes of one match."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) <= LEAF_BYTES:
            return self.merged(data)
        half = len(data) // 2
        return self.joined(self.encoded(data[:half]), self.encoded(data[half:]))

    def _leaf(self, text: str) -> np.ndarray:
        """The ids of all matches of a text; ids of matches seen before are looked up."""
        matches = self.pattern.findall(text)
        if len(self.known) > REMEMBERED:
            self._forget()
        known = self.known
        which = np.fromiter(map(known.get, matches, repeat(-1)), np.int64, len(matches))
        for i in np.flatnonzero(which < 0).tolist():
            match = matches[i]
            if match not in known:
                known[match] = len(known)
                self.flat.extend(self.encoded(match.encode()))
                self.starts.append(len(self.flat))
            which[i] = known[match]
        starts = np.frombuffer(self.starts, np.int64)
        return _stretches(np.frombuffer(self.flat, np.int32), starts[which], starts[which + 1])

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text: halves are cut where no match can reach over the cut."""
        if len(text) > LEAF_TEXT:
            cut = _CUT.search(text, len(text) // 2) or _CUT.search(text, LEAF_TEXT // 2, len(text) // 2)
            if cut:
                return np.concatenate([self.encode(text[: cut.start()]), self.encode(text[cut.start() :])])
        return self._leaf(text)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids, halves behind each other."""
        if ids.size > LEAF_IDS:
            return self.decode(ids[: ids.size // 2]) + self.decode(ids[ids.size // 2 :])
        return _stretches(self.bytes, self.at[ids], self.at[ids + 1]).tobytes()


@functools.lru_cache(maxsize=2)
def _ranks(lines: bytes, pattern: str) -> Ranks:
    return Ranks(lines, pattern)


def _file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _encoder(path: str, pattern: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(_file(path), pattern)
        for batch in batches:
            for part in tv.slices(batch, "text", 4 << 20):
                rows = [ranks.encode(t or "") for t in part.column("text").to_pylist()]
                at = np.concatenate([[0], np.cumsum([r.size for r in rows])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(rows).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in schema.names[:-1]), ids], schema=schema)

    return run


def _decoder(path: str, pattern: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(_file(path), pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                ids = part.column("ids")
                data = [ranks.decode(ids[k].values.to_numpy() if ids[k].is_valid else np.empty(0, np.int32)) for k in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in schema.names[:-1]), pa.array(data, pa.binary())], schema=schema)

    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` (text and any other columns) with ``ids``, the ids of each whole text, in place of text."""
    docs = docs.drop("ids")
    kept = docs.drop("text")
    fields = StructType([*kept.schema.fields, StructField("ids", ArrayType(IntegerType(), False))])
    return docs.mapInArrow(_encoder(path, pattern, to_arrow_schema(fields)), fields)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` (ids and any other columns) with ``data``, the bytes of the ids."""
    encoded = encoded.drop("data")
    fields = StructType([*encoded.schema.fields, StructField("data", BinaryType())])
    return encoded.mapInArrow(_decoder(path, pattern, to_arrow_schema(fields)), fields)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, and SHA-256 of its ids in text and of what they decode to."""
    there_and_back = decode(encode(docs.select("doc_id", "text"), path, pattern), path, pattern)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return there_and_back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
