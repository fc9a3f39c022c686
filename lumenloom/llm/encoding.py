"""Token ids of whole texts by a given tokenizer file, with repeated pieces encoded once.

A byte-level tokenizer never joins two words, so a text may be cut before each single blank, around
each single line end, and between a word of letters and the sentence signs that end it; the pieces'
ids in order are the text's ids. Pieces repeat, so the tokenizers library encodes each once, many new
ones set apart in one text, and a table keeps their ids. Pieces are found and told apart in numpy, by 64-bit hashes. Texts with two
white-space characters in a row, where a cut could differ, or with an added token, are encoded whole.
"""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np

from lumenloom.llm import textvec as tv

#: Pieces remembered by a worker, about 45 bytes each; afterwards it starts anew.
REMEMBERED = 1_200_000
#: Bytes of text cut into pieces at a time; a longer text is a step of its own.
STEP = 2 << 20
#: New pieces that the library gets as one text.
JOINED = 256
_WIDE_SPACE = re.compile(r"\s\s")
_U = np.uint64

# white space below U+0080 as blanks, and how the rest of it begins or is spelled: without these no text has _WIDE_SPACE
_AS_BLANK = bytes(0x20 if b < 0x80 and chr(b).isspace() else b for b in range(256))
_FAR_SPACE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")

_LETTER, _OTHER, _SIGN, _BLANK, _LINE = range(5)
# letters: bytes of A-Z, a-z and of the letters U+00C0 to U+027F; times and divided-by are taken out below
_LETTERS = {*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA)}
_KIND = bytes(
    _LETTER if b in _LETTERS else _SIGN if b in b".,;:!?" else _BLANK if b == 0x20 else _LINE if b == 0x0A else _OTHER
    for b in range(256)
)


def cut(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the pieces of a text without two white-space characters in a row."""
    data, kind = np.frombuffer(text, dtype=np.uint8), np.frombuffer(bytearray(text.translate(_KIND)), dtype=np.uint8)
    odd = np.flatnonzero(data[:-1] == 0xC3)
    kind[odd[(data[odd + 1] == 0x97) | (data[odd + 1] == 0xB7)]] = _OTHER
    edge = np.flatnonzero(np.diff(kind < _BLANK, prepend=False, append=False))
    start, end = edge[::2], edge[1::2].copy()
    # a word of letters is cut off the signs after it
    sign = kind == _SIGN
    runs = np.flatnonzero(sign & np.diff(sign, prepend=False))
    split = np.flatnonzero(sign[end - 1])
    body = runs[np.searchsorted(runs, end[split]) - 1]
    others = np.flatnonzero(sign | (kind == _OTHER))
    word = (body > start[split]) & (np.searchsorted(others, start[split]) == np.searchsorted(others, body))
    split, body = split[word], body[word]
    after = end[split]
    end[split] = body
    # the blank before a word belongs to it
    blank, line = kind == _BLANK, kind == _LINE
    lead = start - ((start > 0) & blank[np.maximum(start - 1, 0)])
    last = np.append(line, True)[1:]  # a blank at the end of a text stands alone
    alone = np.flatnonzero(line | (blank & last))
    starts, ends = np.concatenate([lead, body, alone]), np.concatenate([end, after, alone + 1])
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order]


class Numbers:
    """Numbers of hashes in the order they were added, in an open table that takes and gives whole arrays."""

    def __init__(self) -> None:
        self.size = 0
        self._empty(16)

    def _empty(self, bits: int) -> None:
        self.bits, self.keys, self.numbers = bits, np.zeros(1 << bits, _U), np.full(1 << bits, -1, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> _U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each, -1 for one that was not added."""
        slot = self._slots(keys)
        out = self.numbers[slot]
        rest = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        slot = slot[rest]
        while rest.size:
            slot = (slot + 1) & ((1 << self.bits) - 1)
            out[rest] = got = self.numbers[slot]
            on = (got >= 0) & (self.keys[slot] != keys[rest])
            rest, slot = rest[on], slot[on]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Distinct hashes that are not there yet."""
        bits, size = self.bits, self.size + keys.size
        while size * 8 > 5 << bits:
            bits += 1
        if bits > self.bits:
            used = np.flatnonzero(self.numbers >= 0)
            old, numbers = self.keys[used], self.numbers[used]
            self._empty(bits)
            self._put(old, numbers)
        self._put(keys, np.arange(self.size, size, dtype=np.int32))
        self.size = size

    def _put(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        slot = self._slots(keys)
        while keys.size:
            free = self.numbers[slot] < 0
            self.numbers[slot[free]] = numbers[free]  # one of several for a slot gets it
            got = self.numbers[slot] == numbers
            self.keys[slot[got]] = keys[got]
            keys, numbers, slot = keys[~got], numbers[~got], (slot[~got] + 1) & ((1 << self.bits) - 1)


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.n_bytes = np.zeros(max([self.size - 1, *vocabulary.values(), *self.tokenizer.get_added_tokens_decoder()]) + 1, np.int64)
        # a byte-level token is spelled with one character a byte
        self.n_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self._forget()

    def _forget(self) -> None:
        # the number of each piece's hash; its ids are those from starts[number] to the next start
        self.known = Numbers()
        self.ids, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        return np.fromiter(itertools.chain.from_iterable(rows), dtype=np.uint32, count=int(sizes.sum())), sizes

    def _new(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, JOINED at a time: a blank before a piece, or a line end put there, sets it apart."""
        parts = [p if p[:1] == b" " else b"\n" + p for p in pieces]
        texts: list[str] = []
        for k in range(0, len(parts), JOINED):
            data = b"".join(parts[k : k + JOINED])
            if self._whole(text := data.decode(), data):
                parts[k : k + JOINED] = pieces[k : k + JOINED]
                texts += [p.decode() for p in pieces[k : k + JOINED]]
            else:
                texts.append(text)
        ids, _ = self._library(texts)
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        put = sizes > np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ends, upto = np.concatenate([[0], np.cumsum(self.n_bytes[ids])]), np.concatenate([[0], np.cumsum(sizes)])
        at = np.searchsorted(ends, upto)
        line = at[:-1][put]
        if ends[-1] != upto[-1] or (ends[at] != upto).any() or (self.n_bytes[ids[line]] != 1).any():
            return self._library([p.decode() for p in pieces])  # not a tokenizer of bytes
        return np.delete(ids, line), np.diff(at) - put

    def _whole(self, text: str, data: bytes) -> bool:
        wide = b"  " in data.translate(_AS_BLANK) or (len(data) > len(text) and any(s in data for s in _FAR_SPACE))
        return (wide and bool(_WIDE_SPACE.search(text))) or any(t in text for t in self.added)

    def _pieces(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that may be cut, and the number of ids of each."""
        joined = b"\n".join(texts)
        upto = np.cumsum([0, *(len(t) + 1 for t in texts)])
        start, end = cut(joined)
        between = np.searchsorted(start, upto[1:-1] - 1)  # the line ends that set the texts apart
        start, end = np.delete(start, between), np.delete(end, between)
        keys = tv.span_hashes(np.frombuffer(joined, dtype=np.uint8), start, end)
        if self.known.size > REMEMBERED:
            self._forget()
        piece = self.known.find(keys)
        new = np.flatnonzero(piece < 0)
        if new.size:
            distinct, first, which = np.unique(keys[new], return_index=True, return_inverse=True)
            first = new[first]
            ids, sizes = self._new([joined[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())])
            piece[new] = self.known.size + which
            self.known.add(distinct)
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        at = self.starts[piece]
        size = self.starts[piece + 1] - at
        ends = np.cumsum(size)
        where = np.arange(int(ends[-1]) if ends.size else 0) + np.repeat(at - (ends - size), size)
        total = np.concatenate([[0], ends])[np.searchsorted(start, upto)]
        return self.ids[where], np.diff(total)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order as unsigned 32-bit numbers, and the number of ids of each text."""
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held: list[bytes] = []
        size = 0
        for text in texts:
            data = (text or "").encode()
            if text and self._whole(text, data):
                parts += [self._pieces(held)] if held else []
                parts.append(self._library([text]))
                held, size = [], 0
                continue
            held.append(data)
            size += len(data)
            if size >= STEP:
                parts.append(self._pieces(held))
                held, size = [], 0
        parts += [self._pieces(held)] if held else []
        if not parts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
