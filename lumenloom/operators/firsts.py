"""First-accepted de-duplication: a repeat within a window of the accepted row is dropped.

Whether a row is accepted depends on the row accepted before it, so the rule is a chain. Rows are laid
out by key and time over range partitions, whose bounds Spark samples from the data; a busy key thus
spans many tasks. Only what a task meets first can go on from the task before: there every chain that
any entry could start is followed at once, and each row notes for which entries it is accepted. Chains
that meet go on as one, and a pause as long as the window ends them all. What a task does to the entry
is a step function; such functions compose, so a tree over the tasks finds every entry in logarithmic
depth, and the notes turn into decisions without another pass over the rows.
"""

from __future__ import annotations

import bisect
from collections import deque
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lumenloom.session import written

WINDOW_SECONDS = 300  # fixed value: how long an accepted message shadows its repeats
#: Tasks, or groups of tasks, whose step functions are composed at once.
FAN = 64
#: An entry says from which time on rows are accepted; at the start of a key it is OPEN.
BELOW, OPEN = -(1 << 63), -(1 << 63) + 1

_RANGES = "array<struct<lo: bigint, hi: bigint>>"
_STEPS = "array<struct<upto: bigint, last: bigint>>"
_SUMMARY = f"part int, h1 bigint, h2 bigint, whole boolean, steps {_STEPS}, last bigint"


class _Chains:
    """All chains that entries into one run of close rows can start, as groups that have met."""

    def __init__(self, window: int) -> None:
        self.window, self.heads = window, []
        self.groups: deque[tuple[int, list]] = deque()  # (time accepted last, entries that lead there)

    def add(self, t: int) -> list | None:
        """The entries for which the row at ``t`` is accepted; none if it never is."""
        ranges = []
        while self.groups and self.groups[0][0] + self.window <= t:
            ranges += self.groups.popleft()[1]
        if not self.heads or self.heads[-1] < self.heads[0] + self.window:
            ranges.append((self.heads[-1] if self.heads else BELOW, t))
            self.heads.append(t)
        if not ranges:
            return None
        ranges.sort()
        joined = ranges[:1]
        for lo, hi in ranges[1:]:
            if lo == joined[-1][1]:
                joined[-1] = (joined[-1][0], hi)
            else:
                joined.append((lo, hi))
        self.groups.append((t, joined))
        return joined

    @property
    def met(self) -> bool:
        """Whether every entry there can be leads to the same rows from now on."""
        return len(self.groups) == 1 and self.heads[-1] >= self.heads[0] + self.window

    def steps(self) -> list[tuple[int, int]]:
        """(largest entry, time accepted last), in order of entries; a larger entry is past the run."""
        return _thin(sorted((hi, last) for last, ranges in self.groups for _, hi in ranges))


def _thin(steps: list) -> list:
    """Neighbours with the same result are one step, named by their last entry."""
    return [s for i, s in enumerate(steps) if i + 1 == len(steps) or steps[i + 1][1] != s[1]]


class _Task:
    """The rows of one task, in order, as runs of one key with pauses shorter than the window."""

    def __init__(self, window: int) -> None:
        self.window, self.first, self.key, self.time, self.last = window, None, None, None, None
        self.chains = self.following = None  # of the first run; ``following`` until they have met
        self.whole = True  # only one run so far

    def batch(self, h1: np.ndarray, h2: np.ndarray, times: np.ndarray, known: np.ndarray) -> tuple[list, list]:
        """Places of rows that may be accepted, and the entries for which they are (none: whatever it is)."""
        n, taken, notes = len(times), [], []
        if not n:
            return taken, notes
        same = np.empty(n, dtype=bool)
        same[0] = self.key == (int(h1[0]), int(h2[0])) and self.time is not None and bool(known[0]) and int(times[0]) - self.time < self.window
        same[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1]) & known[1:] & known[:-1] & (times[1:] - times[:-1] < self.window)
        for a, b in pairwise([0, *(np.flatnonzero(~same[1:]) + 1).tolist(), n]):
            if not same[a]:
                if self.first is None:
                    self.first = int(h1[a]), int(h2[a])
                    # what has no time comes first, so nothing of its key is before it
                    self.chains = self.following = _Chains(self.window) if known[a] else None
                else:
                    self.whole, self.following = False, None
                if self.following is None:
                    self.whole = self.whole and self.chains is not None
                    taken.append(a)
                    notes.append(None)
                    self.last = int(times[a]) if known[a] else None
                    a += 1
            while a < b and self.following is not None:
                entries = self.following.add(int(times[a]))
                met = self.following.met
                if entries is not None:
                    taken.append(a)
                    notes.append(None if met else entries)
                if met:
                    self.last, self.following = self.following.groups[0][0], None
                a += 1
            while a < b:
                a += int(np.searchsorted(times[a:b], self.last + self.window))
                if a < b:
                    taken.append(a)
                    notes.append(None)
                    self.last = int(times[a])
                    a += 1
        self.key = int(h1[-1]), int(h2[-1])
        self.time = int(times[-1]) if known[-1] else None
        return taken, notes

    def summary(self, part: int) -> dict:
        if self.whole:
            steps = self.chains.steps() if self.following else [(self.chains.heads[-1], self.last)]
            rest = {"h1": self.first[0], "h2": self.first[1], "whole": True, "steps": steps, "last": None}
        else:
            rest = {"h1": self.key[0], "h2": self.key[1], "whole": False, "steps": None, "last": self.last}
        return {"part": part, "first1": self.first[0], "first2": self.first[1], **rest}


def _marked(window: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, task = TaskContext.get().partitionId(), _Task(window)
        for batch in batches:
            h1, h2, times = (batch.column(c) for c in ("_h1", "_h2", "_t"))
            taken, notes = task.batch(h1.to_numpy(), h2.to_numpy(), times.fill_null(0).to_numpy(), times.is_valid().to_numpy(zero_copy_only=False))
            rows = batch.column("_row").take(pa.array(taken, pa.int64()))
            n = len(taken)
            out = {"row": rows, "ranges": pa.array([r and [{"lo": a, "hi": b} for a, b in r] for r in notes], schema.field("ranges").type), "part": pa.array([part] * n, pa.int32())}
            yield pa.RecordBatch.from_arrays([out.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)
        if task.first is not None:
            one = task.summary(part)
            one["steps"] = one["steps"] and [{"upto": a, "last": b} for a, b in one["steps"]]
            yield pa.RecordBatch.from_pylist([{f.name: one.get(f.name) for f in schema}], schema=schema)

    return run


def _after(f: dict, h1: int, h2: int, last: int | None, window: int) -> tuple:
    """(h1, h2, time accepted last) after a task or group, given the same before it."""
    if not f["whole"]:
        return f["h1"], f["h2"], f["last"]
    entry = _entry(f, h1, h2, last, window)
    at = bisect.bisect_left([s["upto"] for s in f["steps"]], entry)
    return f["h1"], f["h2"], f["steps"][at]["last"] if at < len(f["steps"]) else last


def _entry(f: dict, h1: int, h2: int, last: int | None, window: int) -> int:
    goes_on = last is not None and (h1, h2) == (f["first1"], f["first2"])
    return last + window if goes_on else OPEN


def _composed(f: dict, g: dict, window: int) -> dict:
    """Task or group ``g`` behind ``f``."""
    if not g["whole"]:
        return {**g, "first1": f["first1"], "first2": f["first2"]}
    if not f["whole"] or (f["h1"], f["h2"]) != (g["h1"], g["h2"]):
        last = f["last"] if not f["whole"] else None
        h1, h2, last = _after(g, f["h1"], f["h2"], last, window)
        return {**g, "first1": f["first1"], "first2": f["first2"], "whole": False, "h1": h1, "h2": h2, "steps": None, "last": last}
    steps = [(s["upto"], _after(g, f["h1"], f["h2"], s["last"], window)[2]) for s in f["steps"]]
    beyond = f["steps"][-1]["upto"]
    steps += [(s["upto"], s["last"]) for s in g["steps"] if s["upto"] > beyond]
    return {**f, "steps": [{"upto": a, "last": b} for a, b in _thin(steps)]}


_FUNCTION = f"{_SUMMARY}, first1 bigint, first2 bigint"


def _group(window: int, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        whole = rows[0]
        for r in rows[1:]:
            whole = _composed(whole, r, window)
        whole["part"] = rows[0]["part"] // FAN
        return pa.Table.from_pylist([{k: whole[k] for k in schema.names}], schema=schema)

    return run


def _walk(window: int):
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("last", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (not r["head"], r["part"]))
        state, out = (0, 0, None), []
        for r in rows:
            if r["head"]:
                state = r["h1"], r["h2"], r["last"]
                continue
            out.append({"part": r["part"], "entry": _entry(r, *state, window), "h1": state[0], "h2": state[1], "last": state[2]})
            state = _after(r, *state, window)
        return pa.Table.from_pylist(out, schema=schema)

    return run


def _entries(functions: DataFrame, most: int, window: int) -> DataFrame:
    """part, entry and the state before each part, through a tree of composed functions."""
    groups = F.floor(F.col("part") / FAN).alias("_group")
    nodes = functions.withColumn("head", F.lit(False))
    if most >= FAN:
        schema = to_arrow_schema(functions.schema)
        above = functions.groupBy(groups).applyInArrow(_group(window, schema), functions.schema)
        above = _entries(written(above, "steps"), most // FAN, window)
        heads = above.select((F.col("part") * FAN).alias("part"), "h1", "h2", "last", F.lit(True).alias("head"))
        nodes = nodes.unionByName(heads, allowMissingColumns=True)
    walked = nodes.groupBy(groups).applyInArrow(_walk(window), "part int, entry bigint, h1 bigint, h2 bigint, last bigint")
    return written(walked, "entries")


def fifo_dedup(df: DataFrame, keys: list[str], ts: str, seconds: int = WINDOW_SECONDS, tie: list[str] = (), tasks: int | None = None) -> DataFrame:
    """Rows that are accepted: a repeat of a key within ``seconds`` of the accepted row

    is dropped and does not extend the window. ``keys`` is the de-duplication id, with
    the group if ids count per group; a null is a key like any other. Among rows of one instant the
    first by ``tie`` (or by content) is taken. Rows without a time count as one instant of their key
    that shadows nothing. ``tasks`` is the number of range partitions, the session's unless given.
    """
    window = seconds * 1_000_000
    order = F.struct(*tie) if tie else F.xxhash64(*df.columns)
    row = F.struct(*[F.col(c) for c in df.columns])
    # one row per key and instant, before anything is sorted
    time = F.unix_micros(F.col(ts).cast("timestamp"))
    kept = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], time.alias("_t"), row.alias("_row"), order.alias("_order"))
    names = [f"_k{i}" for i in range(len(keys))]
    first = kept.groupBy(*names, "_t").agg(F.min_by("_row", "_order").alias("_row"))
    # two hashes tell keys of any type apart and lay them out
    laid = first.select(F.xxhash64(*names).alias("_h1"), F.xxhash64(F.lit("second"), *names).alias("_h2"), "_t", "_row")
    by = ["_h1", "_h2", "_t"]
    laid = (laid.repartitionByRange(tasks, *by) if tasks else laid.repartitionByRange(*by)).sortWithinPartitions(*by)
    schema = T.StructType([T.StructField("row", laid.schema["_row"].dataType), *T._parse_datatype_string(f"ranges {_RANGES}, {_FUNCTION}").fields])
    marked = written(laid.mapInArrow(_marked(window, to_arrow_schema(schema)), schema), "accepted")
    functions = marked.where("whole IS NOT NULL").select(*T._parse_datatype_string(_FUNCTION).names)
    most = functions.agg(F.max("part")).first()[0]
    taken = marked.where("whole IS NULL").select("row", "ranges", "part")
    if most is not None:
        entries = _entries(functions, most, window).select("part", "entry")
        fits = F.exists("ranges", lambda r: (r["lo"] < F.col("entry")) & (F.col("entry") <= r["hi"]))
        taken = taken.join(entries, "part").where(F.col("ranges").isNull() | fits)
    return taken.select("row.*")
