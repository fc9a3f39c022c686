"""Sizes of document items, from the JSON text as it lies in an Arrow buffer.

All texts of a batch are scanned at once: quotes outside of escapes give the strings, brackets outside of
strings the depth. Item JSON alternates: at odd depths stand attribute names, items of lists and members of
sets, at even depths the one type name of a value and, for scalars, its text. So a string's place tells what
it counts for, and no text is parsed into objects.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 13, 32]] = True
_HEX = np.zeros(256, dtype=np.int64)
for _digits, _value in (("0123456789", 0), ("abcdef", 10), ("ABCDEF", 10)):
    _HEX[[ord(c) for c in _digits]] = np.arange(len(_digits)) + _value


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind each other, and where each begins; a null is an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return data, at - at[0]


def _odd_backslashes_before(slash: np.ndarray) -> np.ndarray:
    """Whether an odd number of backslashes stands right before each byte."""
    place = np.arange(slash.size)
    other = np.maximum.accumulate(np.where(slash, -1, place))
    run = np.zeros(slash.size, dtype=np.int64)
    run[1:] = (place - other)[:-1]
    return run % 2 == 1


def _shorter(data: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """How many bytes more each escape takes in JSON than its character does in UTF-8."""
    out = np.ones(escapes.size, dtype=np.int64)
    wide = np.flatnonzero(data[escapes + 1] == ord("u"))
    if wide.size:
        code = sum(_HEX[data[escapes[wide] + 2 + k]] << 4 * (3 - k) for k in range(4))
        half = (code >= 0xD800) & (code < 0xE000)  # two halves make four bytes
        out[wide] = 6 - np.where(half, 2, np.where(code < 0x80, 1, np.where(code < 0x800, 2, 3)))
    return out


def item_sizes(column: pa.Array) -> pa.Array:
    """Bytes of each item: UTF-8 names and values, sets add 1 per member, lists 3 and maps 4 per entry."""
    data, at = _buffer(column)
    slash = data == ord("\\")
    escaped = _odd_backslashes_before(slash)
    quote = (data == ord('"')) & ~escaped
    inside = np.cumsum(quote) % 2 == 1
    quotes = np.flatnonzero(quote)
    start, end = quotes[::2], quotes[1::2]
    opener = ((data == ord("{")) | (data == ord("["))) & ~inside
    closer = ((data == ord("}")) | (data == ord("]"))) & ~inside
    depth = np.cumsum(opener.astype(np.int64) - closer)

    # lengths in UTF-8
    escapes = np.flatnonzero(slash & ~escaped & inside)
    saved = np.concatenate([[0], np.cumsum(_shorter(data, escapes))])
    size = end - start - 1 - (saved[np.searchsorted(escapes, end)] - saved[np.searchsorted(escapes, start)])

    # what each string is
    solid = np.append(np.flatnonzero(~_WHITE[data]), data.size)
    after = np.append(data, 0)[solid[np.searchsorted(solid, end + 1)]]
    key, level = after == ord(":"), depth[start] if start.size else np.empty(0, np.int64)
    openers = np.flatnonzero(opener)
    opened = depth[openers]
    container = np.zeros(start.size, dtype=np.int64)  # the bracket that a string stands in
    parent = np.zeros(openers.size, dtype=np.int64)
    for d in np.unique(opened):
        these = openers[opened == d]
        rows = np.flatnonzero(level == d)
        container[rows] = these[np.searchsorted(these, start[rows]) - 1]
        below = np.flatnonzero(opened == d + 1)
        parent[below] = these[np.searchsorted(these, openers[below]) - 1]
    first = data[np.minimum(start + 1, max(data.size - 1, 0))] if data.size else np.empty(0, np.uint8)

    count = np.zeros(start.size, dtype=np.int64)
    name = key & (level % 2 == 1)
    count[name] = size[name] + np.where(level[name] > 1, 4, 0)
    # a boolean or null counts as one
    word = key & (level % 2 == 0) & (size == 4) & ((first == ord("B")) | (first == ord("N")))
    count[word] = 1
    scalar = np.flatnonzero(~key & (level % 2 == 0))
    member = np.flatnonzero(~key & (level % 2 == 1))
    kind = np.zeros(start.size, dtype=np.int64)  # the string that names the type
    kind[scalar] = scalar - 1
    kind[member] = np.searchsorted(start, container[member]) - 1
    texts = np.concatenate([scalar, member])
    binary = first[kind[texts]] == ord("B")
    ends = end[texts]
    padding = (data[ends - 1] == ord("=")).astype(np.int64) + ((data[ends - 1] == ord("=")) & (data[ends - 2] == ord("=")))
    count[texts] = np.where(binary, size[texts] * 3 // 4 - padding, size[texts])
    count[member] += 1

    total = np.bincount(np.searchsorted(at, start, side="right") - 1, weights=count, minlength=len(column))
    # items of lists: values whose bracket stands in a list
    listed = openers[(opened % 2 == 0) & (opened > 2) & (data[parent] == ord("["))] if data.size else openers
    total += 3 * np.bincount(np.searchsorted(at, listed, side="right") - 1, minlength=len(column))
    return pa.array(total.astype(np.int64), pa.int64(), mask=~column.is_valid().to_numpy(zero_copy_only=False))
