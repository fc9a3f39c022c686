"""Repair of the turn structure of conversations, by a shortest path over scalar big integers.

Rows of a conversation are kept, given another role or deleted, and empty rows are inserted, so that the
roles become an optional system row and then pairs of user and assistant, at the least cost. A path is one
integer: its high digits are the cost, its low digits, of fixed width, the letters of its edits from the
left, with zeros for what is behind the end. The ordinary minimum of such integers is the cheapest path,
and of these the one whose letters come first (D, I, K, R; an end comes before all). Nothing else decides.

The graph has a node per row and state (nothing yet, after system, after user, after assistant). The rows
of one conversation may be cut into pieces anywhere: a piece is the matrix of its least integers from state
to state, and matrices of neighbours are multiplied in a tree (minimum of concatenations). That is exact,
since two edit sequences of the same rows and cost are never one the beginning of the other: what is longer
has further inserts, which cost. So a conversation may span any number of tasks.

Rows are ordered by turn, nulls first, then role, then the SHA-256 of the text. Copies of one row are one
row with a count until the letters are dealt out.

Defined results: a null role or text reads as one space, also a null id or turn in the checksum that
damages rows. Rows with a null id are one conversation. Conversations without rows after damage have zeros,
an empty audit and no repaired rows. Columns besides conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from lumenloom.llm.tables import written

#: Costs of the edits; a row that stays although it is truncated adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a conversation that one matrix covers at first, and matrices that are multiplied at once.
PIECE, FAN = 256, 32
WHITE = " \t\n\x0b\x0c\r"

# states: nothing yet, after system, after user, after assistant; what an inserted or renamed row leads to
STATES = range(4)
NEXT = (2, 2, 3, 2)
KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ENDS = (0, 3)
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTER = {ord(str(digit)): letter for letter, digit in LETTERS.items()}
DIGIT = 3  # bits
FINE, CUT_OFF, GONE = range(3)
#: Letters that one row takes at most: two inserts and its own.
EACH = 3


def _ahead(weight: int | None, cost: int, letter: str, bits: int) -> int | None:
    """The path with one more edit in front: costs add, letters move one place to the right."""
    if weight is None:
        return None
    low = weight & ((1 << bits) - 1)
    return ((weight >> bits) + cost << bits) | (LETTERS[letter] << bits - DIGIT) | low >> DIGIT


def _least(*weights: int | None) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def _inserting(onward: list, bits: int) -> list:
    """Least paths if up to two rows may be inserted first."""
    best = onward
    for _ in range(2):
        best = [_least(onward[s], _ahead(best[NEXT[s]], INSERT, "I", bits)) for s in STATES]
    return best


def _backward(codes: tuple, ends: tuple, bits: int, tail: bool) -> list:
    """Least path from each state over all rows of ``codes`` (initial, fault) to one of ``ends``."""
    onward = [0 if s in ends else None for s in STATES]
    if tail:
        onward = _inserting(onward, bits)
    for initial, fault in reversed(codes):
        stay = TRUNCATED if fault == CUT_OFF else 0
        keep, here = KEEP.get(initial, {}), []
        for s in STATES:
            options = [_ahead(onward[s], DELETE, "D", bits)]
            if fault != GONE:
                options.append(_ahead(onward[NEXT[s]], REROLE + stay, "R", bits))
                if s in keep:
                    options.append(_ahead(onward[keep[s]], stay, "K", bits))
            here.append(_least(*options))
        onward = _inserting(here, bits)
    return onward


def _read(weight: int, bits: int) -> tuple[int, str]:
    """Cost and letters of a path: a letter is one octal digit."""
    digits = format(weight & ((1 << bits) - 1), f"0{bits // DIGIT}o").rstrip("0")
    return weight >> bits, digits.translate(_LETTER)


@functools.lru_cache(maxsize=100_000)
def cheapest(codes: tuple) -> tuple[int, str]:
    """Cost and audit letters of a whole conversation."""
    bits = DIGIT * (EACH * len(codes) + 2)
    return _read(_backward(codes, ENDS, bits, True)[0], bits)


def matrix(codes: tuple) -> tuple[int, list]:
    """Width of the letters and least paths from each state to each state, for a piece of a conversation."""
    bits = DIGIT * EACH * len(codes)
    columns = [_backward(codes, (t,), bits, False) for t in STATES]
    return bits, [columns[t][s] for s in STATES for t in STATES]


def _behind(x: int | None, bits_x: int, y: int | None, bits_y: int) -> int | None:
    """One path behind another, in the sum of their widths."""
    if x is None or y is None:
        return None
    low_x, low_y = x & ((1 << bits_x) - 1), y & ((1 << bits_y) - 1)
    free = ((low_x & -low_x).bit_length() - 1) // DIGIT * DIGIT if low_x else bits_x
    return ((x >> bits_x) + (y >> bits_y) << bits_x + bits_y) | low_x << bits_y | low_y << free


def multiplied(a: tuple[int, list], b: tuple[int, list]) -> tuple[int, list]:
    """The matrix of two neighbouring pieces."""
    (bits_a, x), (bits_b, y) = a, b
    cells = [_least(*(_behind(x[4 * s + m], bits_a, y[4 * m + t], bits_b) for m in STATES)) for s in STATES for t in STATES]
    return bits_a + bits_b, cells


def finished(piece: tuple[int, list]) -> tuple[int, str]:
    """Cost and audit letters, once one matrix covers a whole conversation."""
    bits = DIGIT * 2
    columns = [_backward((), (t,), bits, True) for t in STATES]
    width, cells = multiplied(piece, (bits, [columns[t][s] for s in STATES for t in STATES]))
    return _read(_least(*(cells[t] for t in ENDS)), width)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` (conv_id, turn, role, text) after damage by checksum; copies says how often each stands."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("rule"))
    changed = F.when(F.col("rule") == 1, "").when(F.col("rule") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.where("rule <> 0").select("conv_id", "turn", F.when(F.col("rule") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), F.when(F.col("rule") == 3, 2).otherwise(1).alias("copies"))


_ORDER = ("conv_id", "turn", "role", "digest")


def _with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, initial, digest) with copies and the fault of the first copy: blank, again, cut_off."""
    last = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    rows = _with_digest(rows).select(*_ORDER, "copies", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut_off"))
    rows = rows.groupBy(*_ORDER).agg(F.sum("copies").alias("copies"), F.any_value("blank").alias("blank"), F.any_value("cut_off").alias("cut_off"))
    rows = written(rows, "conversation-rows")
    # the first turn that has a role and text, where several have
    same = ["conv_id", "role", "digest"]
    first = rows.groupBy(*same).agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    first = first.select(*(F.col(c).alias(f"_{c}") for c in same), F.col("first.turn").alias("first"), F.lit(True).alias("several"))
    rows = rows.join(first, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same], "left")
    again = F.coalesce("several", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))
    return rows.select(*_ORDER, "copies", "blank", "cut_off", again.alias("again"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_PLAN = "part long, seq long, open boolean, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first string, last string, cost long, audit string, bits long, cells array<binary>"


def _plan_schema(id_field: StructField) -> StructType:
    return StructType([StructField("conv_id", id_field.dataType), *StructType.fromDDL(_PLAN)])


class _Piece:
    """What is known of some neighbouring rows of one conversation."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.codes = conv_id, []
        self.n = dict.fromkeys(_COUNTS, 0)
        self.low = self.high = self.first = self.last = None

    def add(self, turn, role, fault: str | None) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.last = initial
        if turn is not None and turn != self.high:
            self.n["turns"] += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if fault:
            self.n[fault] += 1
        self.codes.append((initial, {None: FINE, "truncated": CUT_OFF}.get(fault, GONE)))

    def row(self, part: int, seq: int, open_: bool) -> dict:
        codes = tuple(self.codes)
        cost, audit = (None, None) if open_ else cheapest(codes)
        bits, cells = matrix(codes) if open_ else (None, None)
        return {"conv_id": self.conv_id, "part": part, "seq": seq, "open": open_, **self.n, "low": self.low, "high": self.high, "first": self.first, "last": self.last, "cost": cost, "audit": audit, "bits": bits, "cells": cells and [_packed(c) for c in cells]}


def _packed(weight: int | None) -> bytes:
    return b"" if weight is None else weight.to_bytes(weight.bit_length() // 8 + 1, "big")


def _unpacked(cells: list) -> list:
    return [int.from_bytes(c, "big") if c else None for c in cells]


def _plans(schema: pa.Schema, size: int):
    """Pieces of the conversations in a task's sorted rows; those that may go on in another task, or are long, stay open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), []
        held, seq, started = None, 0, False

        def close(last: bool) -> None:
            out.append(held.row(part, seq, seq > 0 or last or not started))

        for batch in batches:
            for conv_id, turn, role, copies, blank, cut_off, again in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "copies", "blank", "cut_off", "again"))):
                for k in range(copies):
                    if held is not None and (held.conv_id != conv_id or len(held.codes) == size):
                        same = held.conv_id == conv_id
                        out.append(held.row(part, seq, True)) if same else close(False)
                        started, seq, held = started or not same, seq + 1 if same else 0, None
                    held = held or _Piece(conv_id)
                    held.add(turn, role, "blank" if blank else "duplicate" if again or k else "truncated" if cut_off else None)
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        if held is not None:
            close(True)
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _folded(order: str, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r[order])
        whole = rows[0]
        product = whole["bits"], _unpacked(whole["cells"])
        for r in rows[1:]:
            product = multiplied(product, (r["bits"], _unpacked(r["cells"])))
            touching = whole["last"] + r["first"] not in ("su", "ua", "au")
            shared = whole["high"] is not None and whole["high"] == r["low"]
            for c in _COUNTS:
                whole[c] += r[c]
            whole["illegal"] += touching
            whole["turns"] -= shared
            whole["low"] = r["low"] if whole["low"] is None else whole["low"]
            whole["high"] = whole["high"] if r["high"] is None else r["high"]
            whole["last"] = r["last"]
        whole["bits"], whole["cells"] = product[0], [_packed(c) for c in product[1]]
        whole[order] //= FAN
        return pa.Table.from_pylist([{k: whole[k] for k in schema.names}], schema=schema)

    return run


def _finish(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["cost"], r["audit"] = finished((r["bits"], _unpacked(r["cells"])))
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def plans(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, copies): its faults, and cost and audit of its repair."""
    found = faults(rows)
    spark_schema = _plan_schema(found.schema["conv_id"])
    schema = to_arrow_schema(spark_schema)
    ordered = written(found, "faults").repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    pieces = written(ordered.mapInArrow(_plans(schema, piece), spark_schema), "pieces")
    open_ = pieces.where("open")
    top = open_.agg(F.max("seq").alias("seq"), F.max("part").alias("part")).first()
    for order, fixed in (("seq", ["conv_id", "part"]), ("part", ["conv_id"])):
        most = top[order] or 0
        while most > 0:
            groups = open_.groupBy(*fixed, F.floor(F.col(order) / FAN).alias("_group"))
            open_ = written(groups.applyInArrow(_folded(order, schema), spark_schema), "pieces")
            most //= FAN
    whole = pieces.where("NOT open").unionByName(open_.mapInArrow(_finish(schema), spark_schema))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return written(whole.select("conv_id", gaps.alias("gaps"), *_COUNTS[:-1], "cost", "audit"), "plans")


def _rendered(schema: pa.Schema):
    """Repaired rows of conversations that come one after another: first the audit, then the rows in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        conv_id = letters = None
        at = state = position = 0

        def emit(edit: str, role: str, text: str) -> None:
            nonlocal position, size
            out.append({"conv_id": conv_id, "position": position, "role": role, "text": text, "edit": edit})
            position, size = position + 1, size + len(text) + 64

        def inserts() -> None:
            nonlocal at, state
            while at < len(letters) and letters[at] == "I":
                at, state = at + 1, NEXT[state]
                emit("I", "user" if state == 2 else "assistant", "")

        for batch in batches:
            for this, audit, role, text, copies in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "copies"))):
                if audit is not None:
                    conv_id, letters, at, state, position = this, audit, 0, 0, 0
                    inserts()
                    continue
                for _ in range(copies):
                    edit, at = letters[at], at + 1
                    if edit == "K":
                        state = KEEP[role[:1]][state]
                        emit("K", role, text)
                    elif edit == "R":
                        state = NEXT[state]
                        emit("R", "user" if state == 2 else "assistant", text)
                    inserts()
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, position, role, text, edit (K, R or I), each conversation in one task and in order.

    A conversation's rows stream through their task, so none is held whole, however long it is.
    """
    texts = _with_digest(rows).select(*_ORDER, F.lit(None).cast("string").alias("audit"), "text", "copies")
    heads = plan.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"), "audit", F.lit(None).cast("string").alias("text"), F.lit(0).alias("copies"))
    stream = texts.unionByName(heads).withColumn("later", F.col("audit").isNull())
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "later", "turn", "role", "digest")
    fields = StructType([plan.schema["conv_id"], *StructType.fromDDL("position long, role string, text string, edit string")])
    return stream.mapInArrow(_rendered(to_arrow_schema(fields)), fields)


def _hashed(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sha = None, None
        for batch in batches:
            out = []
            for conv_id, position, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "position", "role", "text"))):
                if position == 0:
                    if sha:
                        out.append({"conv_id": held, "repaired_sha256": sha.hexdigest()})
                    held, sha = conv_id, hashlib.sha256()
                sha.update(f"{role}:{text}".encode() if position == 0 else f"\n{role}:{text}".encode())
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if sha:
            yield pa.RecordBatch.from_pylist([{"conv_id": held, "repaired_sha256": sha.hexdigest()}], schema=schema)

    return run


def report(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row for every conv_id of ``conversations`` (conv_id, turn, role, text): faults after damage, cost, audit and hash of the repair."""
    rows = damaged(conversations)
    plan = plans(rows, piece)
    fields = StructType([plan.schema["conv_id"], StructField("repaired_sha256", StructType.fromDDL("x string")[0].dataType)])
    hashes = repaired(rows, plan).mapInArrow(_hashed(to_arrow_schema(fields)), fields)
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    both = plan.join(hashes.withColumnRenamed("conv_id", "_h"), F.col("conv_id").eqNullSafe(F.col("_h")), "left").withColumn("planned", F.lit(True))
    both = ids.join(both, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *_COUNTS[:-1], "cost")]
    return both.select(F.col("_id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
