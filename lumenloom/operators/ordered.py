"""Ordered per-key work that stays parallel when one key holds most of the rows.

A plain window hands all rows of a key to one task. Here rows are laid out by key and order over range
partitions, whose bounds Spark samples from the data, so a busy key spans many tasks. Each task reads its
rows once, in order, and says in one row how it begins and ends; a scan over these few rows, one for each
task, tells every task what the tasks before and after it have to hand on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lumenloom.session import written

_LAYOUT = ["_h1", "_h2"]


def _shifted(column: pa.Array, edge: pa.Array, index: np.ndarray, known: np.ndarray) -> pa.Array:
    """``column`` behind one ``edge`` value, read at ``index`` where ``known``, null elsewhere."""
    both = pa.chunked_array([edge, column]).combine_chunks() if len(edge) else column
    return both.take(pa.array(index, pa.int64(), mask=~known))


def _running(values: np.ndarray, new: np.ndarray, carry) -> np.ndarray:
    """Sums that start anew where ``new``; the first stretch goes on from ``carry``."""
    starts = np.flatnonzero(new)
    if values.dtype.kind == "f":
        out = np.empty_like(values)
        for a, b in zip([0, *starts], [*starts, len(values)]):
            out[a:b] = np.cumsum(values[a:b]) + (carry if a == 0 and not (len(new) and new[0]) else 0.0)
        return out
    total = np.cumsum(values)
    before = np.concatenate([[0], total])[starts]
    base = np.concatenate([[-carry], before])[np.cumsum(new)]
    return total - base


class _Scan:
    """One pass over the sorted rows of a task."""

    def __init__(self, schema: pa.Schema, passed: list[str], n_before: int, n_after: int, totals: list[str]) -> None:
        self.schema, self.passed = schema, passed
        self.before, self.after, self.totals = range(n_before), range(n_after), totals
        self.key = self.first = self.held = None
        self.rows, self.whole = 0, True
        self.carry = [0.0 if t == "double" else 0 for t in totals]

    def _named(self, columns: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in self.schema], schema=self.schema)

    def batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        opening = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            h = np.stack([batch.column(c).to_numpy() for c in _LAYOUT])
            new = np.ones(n, dtype=bool)
            new[1:] = (h[:, 1:] != h[:, :-1]).any(axis=0)
            new[0] = self.key is None or tuple(h[:, 0]) != self.key
            if self.key is None:
                self.first, opening = tuple(h[:, 0]), batch.slice(0, 1)
            out = {c: batch.column(c) for c in self.passed}
            place = np.arange(n)
            for i in self.before:
                value = batch.column(f"_before{i}")
                edge = self.held[f"_before{i}"] if self.held else value.slice(0, 1)
                out[f"_previous{i}"] = _shifted(value, edge, place, ~new)
            for i, kind in enumerate(self.totals):
                value = batch.column(f"_value{i}").fill_null(0).to_numpy()
                sums = _running(value, new, self.carry[i])
                out[f"_total{i}"] = pa.array(sums, self.schema.field(f"_total{i}").type)
                self.carry[i] = sums[-1].item()
            out["_opening"] = pa.array((h == np.array(self.first)[:, None]).all(axis=0))
            self.whole = self.whole and bool(out["_opening"][-1].as_py())
            edge_of = np.zeros(n, dtype=np.int8)
            edge_of[0] = self.rows == 0
            out["_edge"] = pa.array(edge_of)
            out["part"] = pa.array(np.full(n, part, dtype=np.int32))
            # the row before waits until its follower is known
            if self.held:
                follower = {f"_next{i}": _shifted(batch.column(f"_after{i}"), batch.column(f"_after{i}").slice(0, 0), np.zeros(1, np.int64), ~new[:1]) for i in self.after}
                yield self._named(self.held["row"] | follower, 1)
            for i in self.after:
                value = batch.column(f"_after{i}")
                out[f"_next{i}"] = _shifted(value, value.slice(0, 0), np.minimum(place + 1, n - 1), np.append(~new[1:], False))
            if n > 1:
                yield self._named({c: a.slice(0, n - 1) for c, a in out.items()}, n - 1)
            self.held = {"row": {c: a.slice(n - 1) for c, a in out.items() if not c.startswith("_next")}}
            self.held |= {c: batch.column(c).slice(n - 1) for c in (f"_before{i}" for i in self.before)}
            self.key, self.rows = tuple(h[:, -1]), self.rows + n
        if self.key is not None:
            last = self.held["row"]
            last["_edge"] = pa.array(np.array(last["_edge"]) + 2, pa.int8())
            yield self._named(last, 1)
            ends = {"part": last["part"], "whole": pa.array([self.whole])}
            ends |= {c: pa.array([k], pa.int64()) for c, k in zip(("first1", "first2", "last1", "last2"), (*self.first, *self.key))}
            ends |= {f"_previous{i}": self.held[f"_before{i}"] for i in self.before}
            ends |= {f"_next{i}": opening.column(f"_after{i}") for i in self.after}
            ends |= {f"_total{i}": pa.array([c], self.schema.field(f"_total{i}").type) for i, c in enumerate(self.carry)}
            yield self._named(ends, 1)


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, Column] | None = None,
    following: dict[str, Column] | None = None,
    totals: dict[str, Column] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Adds, per key in the order of ``order``: values of the row before, of the row after, and running sums.

    ``previous`` and ``following`` name values of the neighbour, null where a key begins or ends; ``totals``
    names sums up to and including the row (whole numbers or doubles, a null counts as 0). Nulls come first
    in the order, which must be unique within a key; a null is a key like any other. All columns come from
    one pass. ``tasks`` is the number of range partitions, the session's unless given.
    """
    previous, following, totals = previous or {}, following or {}, totals or {}
    values = [v.alias(f"_before{i}") for i, v in enumerate(previous.values())]
    values += [v.alias(f"_after{i}") for i, v in enumerate(following.values())]
    summed = df.select(*[v.alias(f"_value{i}") for i, v in enumerate(totals.values())]).schema.fields if totals else []
    kinds = ["double" if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else "bigint" for f in summed]
    values += [v.cast(k).alias(f"_value{i}") for i, (v, k) in enumerate(zip(totals.values(), kinds))]
    sides = [F.xxhash64(*keys).alias("_h1"), F.xxhash64(F.lit("second"), *keys).alias("_h2")]
    staged = df.select("*", *values, *sides)
    by = [*_LAYOUT, *order]
    laid = (staged.repartitionByRange(tasks, *by) if tasks else staged.repartitionByRange(*by)).sortWithinPartitions(*by)
    kind = lambda name: staged.schema[name].dataType
    fields = [T.StructField(f.name, f.dataType) for f in df.schema]
    fields += [T.StructField(f"_previous{i}", kind(f"_before{i}")) for i in range(len(previous))]
    fields += [T.StructField(f"_next{i}", kind(f"_after{i}")) for i in range(len(following))]
    fields += [T.StructField(f"_total{i}", kind(f"_value{i}")) for i in range(len(totals))]
    rest = "_opening boolean, _edge tinyint, part int, whole boolean, first1 bigint, first2 bigint, last1 bigint, last2 bigint"
    schema = T.StructType([*fields, *T._parse_datatype_string(rest).fields])
    names = (to_arrow_schema(schema), df.columns, len(previous), len(following), kinds)
    scanned = written(laid.mapInArrow(lambda batches: _Scan(*names).batches(batches), schema), "ordered")

    # one row for each task: what goes on into it from the tasks before, and from it into the next
    line = Window.orderBy("part")
    ends = scanned.where("whole IS NOT NULL")
    before = lambda c: F.lag(c).over(line)
    goes_on = F.coalesce((F.col("first1") == before("last1")) & (F.col("first2") == before("last2")), F.lit(False))
    ends = ends.withColumn("goes_on", goes_on).withColumn("stretch", F.sum(F.when(F.col("goes_on") & F.col("whole"), 0).otherwise(1)).over(line))
    so_far = Window.partitionBy("stretch").orderBy("part")
    # the key that a task ends with has summed so much, over all the tasks that hold nothing else
    ends = ends.withColumns({f"_sum{i}": F.sum(f"_total{i}").over(so_far) for i in range(len(totals))})
    carried = [F.when(F.col("goes_on"), before(f"_previous{i}")).alias(f"_from{i}") for i in range(len(previous))]
    carried += [F.when(F.lead("goes_on").over(line), F.lead(f"_next{i}").over(line)).alias(f"_to{i}") for i in range(len(following))]
    carried += [F.when(F.col("goes_on"), before(f"_sum{i}")).alias(f"_add{i}") for i in range(len(totals))]
    rows = scanned.where("whole IS NULL").join(ends.select("part", *carried), "part")
    made = [F.when(F.col("_edge") % 2 == 1, F.col(f"_from{i}")).otherwise(F.col(f"_previous{i}")).alias(n) for i, n in enumerate(previous)]
    made += [F.when(F.col("_edge") >= 2, F.col(f"_to{i}")).otherwise(F.col(f"_next{i}")).alias(n) for i, n in enumerate(following)]
    added = lambda i: F.when(F.col("_opening"), F.coalesce(f"_add{i}", F.lit(0))).otherwise(0)
    made += [(F.col(f"_total{i}") + added(i)).alias(n) for i, n in enumerate(totals)]
    return rows.select(*df.columns, *made)


def previous_row(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, tasks: int | None = None) -> DataFrame:
    """Adds ``value`` of the row before in key order; null on the first row of a key."""
    return with_neighbours(df, keys, order, previous={name: value}, tasks=tasks)


def running_total(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, tasks: int | None = None) -> DataFrame:
    """Adds the sum of ``value`` up to and including each row in key order."""
    return with_neighbours(df, keys, order, totals={name: value}, tasks=tasks)
