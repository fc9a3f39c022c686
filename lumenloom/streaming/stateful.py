"""Stateful streams: period statistics, first-accepted rows, change images, device state.

All state is Spark's own, in its state store. Statistics and device state are aggregates, which combine
before the shuffle, so a busy key stays cheap. De-duplication and change images follow an order within a
key; their state is a map per key, cut into chunks of the order, of which a row touches its neighbours
only. What one key brings into a micro-batch is sorted in one task: a trigger limit (maxFilesPerTrigger)
bounds it.
"""

from __future__ import annotations

import bisect
import json
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lumenloom.operators.changes import VIEWS, WINDOW_SECONDS
from lumenloom.operators.devices import state_versions
from lumenloom.operators.metrics import fill_statistics


def stream_metrics(sdf: DataFrame, ts: str, period: int, delay: str, keys: list[str] = ()) -> DataFrame:
    """Period statistics of a live feed; a period is final once the watermark passes it.

    Rows that come later than ``delay`` are dropped.
    """
    rows = fill_statistics(sdf).withWatermark(ts, delay)
    named = F.when(F.trim("unit") != "", F.col("unit"))
    stats = rows.groupBy(F.window(ts, f"{period} seconds"), *keys).agg(
        F.sum("sample_count").alias("sample_count"),
        F.sum("sum").alias("sum"),
        F.min("minimum").alias("minimum"),
        F.max("maximum").alias("maximum"),
        F.min_by(named, F.when(named.isNotNull(), F.struct(ts, "unit"))).alias("unit"),
    )
    average = F.when(F.col("sample_count") > 0, F.col("sum") / F.col("sample_count")).otherwise(0.0)
    return stats.select(
        F.unix_timestamp("window.start").alias("period_start"),
        *keys,
        "sample_count",
        "sum",
        average.alias("average"),
        "minimum",
        "maximum",
        F.coalesce("unit", F.lit("None")).alias("unit"),
    )


# ── outputs of a micro-batch ─────────────────────────────────────────────────────


def _batch_path(base: str, batch_id: int) -> str:
    return f"{base}/batch={batch_id}"


def _split_writer(sdf: DataFrame, path: str, name: str):
    """A writer of rows below path/``name`` and, where ``_late`` is true, below path/late.

    A batch that runs again replaces its folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # two folders from one run of the operator
        for place, some in ((name, ~F.col("_late")), ("late", F.col("_late"))):
            batch.where(some).drop("_late").write.mode("overwrite").parquet(_batch_path(f"{path}/{place}", batch_id))
        batch.unpersist()

    return sdf.writeStream.foreachBatch(write)


# ── first accepted rows ──────────────────────────────────────────────────────────


def _nulls_first(values) -> tuple:
    return tuple((v is not None, v) for v in values)


class _Blocks:
    """Rows of one key in blocks of a temporary file; of each, its time alone is held. Of one instant, a block keeps the first."""

    SIZE = 10_000

    def __init__(self) -> None:
        self.file = tempfile.SpooledTemporaryFile(1 << 24)
        self.times: list[np.ndarray] = []
        self.packed = 0
        self.open: dict = {}

    def add(self, t: int, order: tuple, values: tuple) -> None:
        if t not in self.open or order < self.open[t][0]:
            self.open[t] = order, values
            if len(self.open) == self.SIZE:
                self.pack()

    def pack(self) -> None:
        self.times.append(np.fromiter(self.open, np.int64, len(self.open)))
        pickle.dump((self.times[-1], list(self.open.values())), self.file, pickle.HIGHEST_PROTOCOL)
        self.packed += 1
        self.open = {}

    def instants(self) -> tuple[np.ndarray, np.ndarray]:
        """All times in order, and in how many blocks each is; ends what is held of them."""
        self.pack()
        times, self.times = np.concatenate(self.times), []
        times.sort()
        new = np.append(True, times[1:] != times[:-1])[: times.size]
        at = np.flatnonzero(new)
        return times[new], np.diff(at, append=times.size).astype(np.int32)

    def firsts(self, times: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[int, tuple]]:
        """Time and values of the first row of each of some instants (in order), given in how many blocks they are."""
        left, best = dict(zip(times[blocks > 1].tolist(), blocks[blocks > 1].tolist())), {}
        self.file.seek(0)
        for _ in range(self.packed if times.size else 0):
            held, rows = pickle.load(self.file)
            at = np.minimum(np.searchsorted(times, held), times.size - 1)
            for i in np.flatnonzero(times[at] == held).tolist():
                t = int(held[i])
                if t in left:
                    if t not in best or rows[i][0] < best[t][0]:
                        best[t] = rows[i]
                    left[t] -= 1
                    if left[t]:
                        continue
                    yield t, best.pop(t)[1]
                else:
                    yield t, rows[i][1]


class _FirstAccepted(StatefulProcessor):
    """State: the accepted times of a key, in microseconds, per chunk of some windows.

    Two accepted times are a window apart at least, so a chunk holds one a window, and whether a row is
    accepted depends on its own chunk and the two beside it. Rows are taken in the order of their times, so
    no other chunk is held.
    """

    #: Windows of a chunk, and rows of a key that leave as one.
    WINDOWS, TOGETHER = 64, 100

    def __init__(self, window: int, columns: list[str], keep: int | None) -> None:
        self.window, self.columns, self.expires = window, columns, keep is not None
        # what is forgotten is forgotten by chunks: they are short beside what is kept
        self.width = window * (min(max(keep // (16 * window), 1), self.WINDOWS) if self.expires else self.WINDOWS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("accepted", "chunk bigint", "times array<bigint>")

    def _times(self, chunk: int) -> list[int]:
        held = self.chunks.getValue((chunk,))
        return list(held[0]) if held else []

    def _keep(self, chunk: int, times: list[int]) -> None:
        self.chunks.updateValue((chunk,), (times,))
        gone = ((chunk + 1) * self.width + self.window) // 1000  # milliseconds: a window after the chunk has ended
        if self.expires and chunk != _NO_TIME and gone > 0:
            self.handle.registerTimer(gone)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        blocks, untimed = _Blocks(), None
        for row in rows:
            t, order, values = row["_t"], _nulls_first(row["_order"]), tuple(row[c] for c in self.columns)
            if t is not None:
                blocks.add(t, order, values)
            elif untimed is None or order < untimed[0]:
                untimed = order, values
        stored = self.chunks.exists()
        # rows without a time are one instant of their key, in a chunk of their own
        if untimed is not None and not (stored and self._times(_NO_TIME)):
            self._keep(_NO_TIME, [0])
            yield self._out([(*untimed[1], False)])
        times, count = blocks.instants()
        final = timerValues.getCurrentWatermarkInMs() * 1000 if self.expires else None
        told = self._told(times, final, stored)
        out = told > 0
        late = set(times[told == 2].tolist())
        ready: list[tuple] = []
        for t, values in blocks.firsts(times[out], count[out]):
            ready.append((*values, t in late))
            if len(ready) == self.TOGETHER:
                yield self._out(ready)
                ready = []
        if ready:
            yield self._out(ready)

    def _told(self, times: np.ndarray, final: int | None, stored: bool) -> np.ndarray:
        """What becomes of the first row of each instant (in order): 1 accepted, 2 late, 0 a repeat."""
        known: dict[int, list[int]] = {}
        changed: set[int] = set()
        at = int(np.searchsorted(times, final)) if final is not None else 0
        told = np.zeros(len(times), dtype=np.int8)
        told[:at] = 2
        while at < len(times):
            t = int(times[at])
            first, last = (t - self.window) // self.width, (t + self.window) // self.width
            before = after = None
            for c in range(first, last + 1):
                if c not in known:
                    known[c] = self._times(c) if stored else []
                i = bisect.bisect_right(known[c], t)
                before = known[c][i - 1] if i else before
                after = known[c][i] if after is None and i < len(known[c]) else after
            for c in [c for c in known if c < first]:
                held = known.pop(c)
                if c in changed:
                    self._keep(c, held)
                    changed.remove(c)
            if before is None or before + self.window <= t:
                if after is not None and after < t + self.window:
                    # a later row was accepted that this one would have shadowed
                    told[at] = 2
                    at += 1
                    continue
                told[at] = 1
                bisect.insort(known[t // self.width], t)
                changed.add(t // self.width)
                before = t
            # all up to a window after an accepted row are repeats
            at += int(np.searchsorted(times[at:], before + self.window))
        for c in changed:
            self._keep(c, known[c])
        return told

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        chunk = (expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.window) // self.width - 1
        if self.chunks.containsKey((chunk,)):
            self.chunks.removeKey((chunk,))
        return iter([])

    def _out(self, rows: list[tuple]) -> Row:
        # Spark gathers all a key gives in one batch before it sends it: many rows go as the bytes of one
        packed = pickle.dumps(rows, pickle.HIGHEST_PROTOCOL)
        return Row(**dict.fromkeys([*self.columns, "_late"]), _packed=packed)

    def close(self) -> None:
        pass


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that came as bytes, by the types of the other columns."""
    for batch in batches:
        schema = pa.schema(list(batch.schema)[:-1])
        for packed in batch.column(batch.num_columns - 1):
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in pickle.loads(packed.as_py())], schema=schema)


_NO_TIME = -(1 << 62)


def stream_fifo_dedup(
    sdf: DataFrame,
    keys: list[str],
    ts: str,
    path: str,
    seconds: int = WINDOW_SECONDS,
    tie: list[str] = (),
    keep_seconds: int | None = None,
):
    """A writer of first-accepted rows below path/rows, and of rows that came too late below path/late.

    A row is a repeat if it is within ``seconds`` after an accepted row of its key. Rows may come in any
    order: a late one is accepted where no accepted row is near, as the batch twin would. It is too late,
    and no more than reported, where it would have shadowed a row that is out already, or where it is more
    than ``keep_seconds`` behind the newest row of the stream: then what was accepted around it is
    forgotten, chunk by chunk, when the watermark has passed. Without ``keep_seconds`` nothing is forgotten.
    """
    columns = sdf.columns
    order = F.struct(*tie) if tie else F.struct(F.xxhash64(*columns).alias("h"))
    time = F.col(ts).cast("timestamp")
    rows = sdf.select(*columns, F.unix_micros(time).alias("_t"), order.alias("_order"), time.alias("_clock"))
    if keep_seconds is not None:
        rows = rows.withWatermark("_clock", f"{keep_seconds} seconds")
    # the clock stays behind: of rows that carry it, Spark would drop the late ones before anybody sees them
    rows = rows.drop("_clock")
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in sdf.schema), T.StructField("_late", T.BooleanType())])
    processor = _FirstAccepted(seconds * 1_000_000, columns, None if keep_seconds is None else keep_seconds * 1_000_000)
    packed = T.StructType([*schema, T.StructField("_packed", T.BinaryType())])
    decided = rows.groupBy(*keys).transformWithState(
        processor, packed, outputMode="Append", timeMode="None" if keep_seconds is None else "EventTime"
    )
    return _split_writer(decided.mapInArrow(_unpacked, schema), path, "rows")


# ── change images ────────────────────────────────────────────────────────────────


def _as_state(value, kind: T.DataType):
    """A value of a row as state takes it: structs as tuples, at any depth."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        parts = [value[n] for n in kind.names] if isinstance(value, dict) else value
        return tuple(_as_state(v, f.dataType) for v, f in zip(parts, kind.fields))
    if isinstance(kind, T.ArrayType):
        return [_as_state(v, kind.elementType) for v in value]
    return value


def _as_output(value, kind: T.DataType):
    """A value of the state as rows take it: structs as dicts, at any depth."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return {f.name: _as_output(v, f.dataType) for v, f in zip(value, kind.fields)}
    if isinstance(kind, T.ArrayType):
        return [_as_output(v, kind.elementType) for v in value]
    return value


def _name(value):
    """What equal values of a key have in common, as grouping sees them: zeros and not-a-numbers are equal."""
    if isinstance(value, dict):
        return tuple(map(_name, value.values()))
    if isinstance(value, list):
        return tuple(map(_name, value))
    if isinstance(value, float):
        return "NaN" if value != value else value + 0.0
    return value


class _Versions(StatefulProcessor):
    """State: of each cell of keys the versions in order, per chunk of sequence numbers, and the keys' chunks and highest numbers.

    A call of the state store, the start of a group and the sending of its events each cost more than a key's
    versions, so keys come in buckets, of which the touched cells alone are read and written.
    """

    def __init__(self, n_keys: int, names: list[str], image: T.StructType, width: int, keep: int | None, view: str) -> None:
        self.n_keys, self.names, self.image, self.width, self.keep, self.view = n_keys, names, image, width, keep, VIEWS[view]

    def init(self, handle: StatefulProcessorHandle) -> None:
        # pickled: by key, lists of [seq, gone, revision, shown, image]; and by key, the highest number and the chunks
        self.chunks = handle.getMapState("versions", "cell int, chunk bigint", "versions binary")
        self.heads = handle.getMapState("heads", "cell int", "heads binary")

    def handleInputRows(self, bucket, rows, timerValues) -> Iterator[Row]:
        stored = self.heads.exists()
        cells: dict = {}
        for row in rows:
            seq, gone, image, cell = row[self.n_keys : self.n_keys + 4]
            key = row[: self.n_keys]
            versions = cells.setdefault(cell, {}).setdefault(tuple(map(_name, key)), (key, []))[1]
            versions.append((seq, bool(gone), _as_state(image, self.image)))
        while cells:
            yield from self._cell(*cells.popitem(), stored)

    def _cell(self, cell: int, keys: dict, stored: bool) -> Iterator[Row]:
        found = self.heads.getValue((cell,)) if stored else None
        heads = pickle.loads(found[0]) if found else {}
        chunks: dict[int, dict] = {}
        changed: set[int] = set()

        def chunk(c: int) -> dict:
            if c not in chunks:
                held = self.chunks.getValue((cell, c)) if found else None
                chunks[c] = pickle.loads(held[0]) if held else {}
            return chunks[c]

        for name, (key, rows) in keys.items():
            key = [v + 0.0 if isinstance(v, float) else v for v in key]
            yield from self._events(key, name, rows, heads, chunk, changed)
        for c in changed:
            if chunks[c]:
                self.chunks.updateValue((cell, c), (pickle.dumps(chunks[c], pickle.HIGHEST_PROTOCOL),))
            else:
                self.chunks.removeKey((cell, c))
        if changed:
            self.heads.updateValue((cell,), (pickle.dumps(heads, pickle.HIGHEST_PROTOCOL),))

    def _events(self, key: list, name: tuple, rows: list[tuple], heads: dict, chunk, changed: set[int]) -> Iterator[Row]:
        """The events of one key; versions that come in order touch its last chunk only."""
        top, places = heads.get(name, (None, []))
        oldest = None if self.keep is None or top is None else top - self.keep
        touched, fresh = set(), set()

        def neighbour(c: int, i: int, step: int) -> list | None:
            """The version before (-1) or after (1) place ``i`` of chunk ``c``, and where it is."""
            if 0 <= i + step < len(chunk(c)[name]):
                return [c, chunk(c)[name][i + step]]
            at = bisect.bisect_left(places, c) + step
            if 0 <= at < len(places):
                return [places[at], chunk(places[at])[name][-1 if step < 0 else 0]]
            return None

        for seq, gone, image in sorted(rows, key=lambda r: r[0]):
            if oldest is not None and seq < oldest:
                yield self._out(key, seq, None, image, None, 0, True)
                continue
            c = seq // self.width
            if name not in chunk(c):
                chunk(c)[name] = []
                bisect.insort(places, c)
            versions = chunk(c)[name]
            at = bisect.bisect_left(versions, seq, key=lambda v: v[0])
            if at < len(versions) and versions[at][0] == seq:
                continue  # a number names one version: this one has come before
            versions.insert(at, [seq, gone, 0, False, image])
            touched.add(c)
            fresh.add(seq)
        # what has to be told: new versions, and old ones whose predecessor is new
        told = {}
        for c in sorted(touched):
            for i, v in enumerate(chunk(c)[name]):
                if v[0] in fresh:
                    told[v[0]] = c, v, neighbour(c, i, -1)
                    after = neighbour(c, i, 1)
                    if after and after[1][0] not in fresh:
                        told[after[1][0]] = after[0], after[1], [c, v]
        for seq in sorted(told):
            c, v, before = told[seq]
            old = None if before is None or before[1][1] else before[1][4]
            event = "REMOVE" if v[1] else "INSERT" if old is None else "MODIFY"
            is_new, shown = seq in fresh, not (event == "REMOVE" and old is None)
            if shown or v[3]:
                v[2] += not is_new
                new = None if v[1] or not shown or not self.view[0] else v[4]
                yield self._out(key, seq, event if shown else None, new, old if shown and self.view[1] else None, v[2], False)
            v[3] = shown
            touched.add(c)
        changed |= touched
        if fresh and (top is None or max(fresh) > top):
            before, top = top, max(fresh)
            if self.keep is not None and (before is None or before // self.width < top // self.width):
                while places and (places[0] + 1) * self.width <= top - self.keep:
                    changed.add(places[0])
                    del chunk(places.pop(0))[name]
        if fresh:
            heads[name] = top, places

    def _out(self, key, seq, name, new, old, revision: int, late: bool) -> Row:
        images = (_as_output(x, self.image) for x in (new, old))
        return Row(**dict(zip(self.names, (*key, seq, name, *images, revision, late))))

    def close(self) -> None:
        pass


#: Groups that the cells of a change stream fall into.
BUCKETS = 4096


def stream_cdc(
    sdf: DataFrame,
    keys: list[str],
    seq: str,
    path: str,
    width: int,
    view: str = "NEW_AND_OLD_IMAGES",
    deleted: Column | None = None,
    keep: int | None = None,
    cells: int = 1 << 16,
):
    """A writer of change events (with images) below path/events, and of versions too late below path/late.

    A row is a version of its key, ``seq`` its whole number, ``deleted`` whether it is a removal. Versions
    may come in any order. One that comes late gives its event, and the version behind it, whose old image
    has changed, another one with the next ``revision``; if nothing is left to tell (the removal of what is
    not there) its event name is null. So per key and seq the event of the highest revision is that of
    the batch twin. A number that comes again is ignored. Versions are kept in chunks of ``width`` numbers;
    ``keep`` is how many numbers behind the highest a version may be, for ever unless given. Keys fall into
    ``cells``, whose state is read and written as one; the number stays as long as the checkpoint is used.
    """
    images = [c for c in sdf.columns if c not in keys]
    gone = deleted if deleted is not None else F.lit(False)
    cell = F.pmod(F.xxhash64(*keys), F.lit(cells)).cast("int").alias("_cell")
    rows = sdf.select(*keys, F.col(seq).cast("bigint").alias("_seq"), F.coalesce(gone, F.lit(False)).alias("_gone"), F.struct(*images).alias("_image"), cell)
    rows = rows.withColumn("_bucket", F.col("_cell") % BUCKETS)
    image = T.StructType([T.StructField(c, sdf.schema[c].dataType) for c in images])
    schema = T.StructType(
        [
            *(T.StructField(k, sdf.schema[k].dataType) for k in keys),
            T.StructField(seq, T.LongType()),
            T.StructField("event_name", T.StringType()),
            T.StructField("new_image", image),
            T.StructField("old_image", image),
            T.StructField("revision", T.IntegerType()),
            T.StructField("_late", T.BooleanType()),
        ]
    )
    events = rows.groupBy("_bucket").transformWithState(
        _Versions(len(keys), schema.names, image, width, keep, view), schema, outputMode="Append", timeMode="None"
    )
    return _split_writer(events, path, "events")


def latest_events(events: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The events that hold in the end: the highest revision of each version, without withdrawn ones."""
    row = F.struct(*[F.col(c) for c in events.columns if c not in (*keys, seq)])
    last = events.groupBy(*keys, seq).agg(F.max_by(row, "revision").alias("_row"))
    return last.select(*keys, seq, "_row.*").where("event_name IS NOT NULL").select(*events.columns)


# ── device state ─────────────────────────────────────────────────────────────────


def stream_device_state(sdf: DataFrame, path: str):
    """A writer of device state: the entries a micro-batch touches, below path/patches.

    State is one entry per (device, section, key), the patch with the highest sequence, so a patch writes its
    own entries however many devices and entries there are; patches may come in any order. A null key
    stands for its whole section, as in a patch. ``merge_state`` over all folders is the state.
    """
    latest = sdf.groupBy("device", "section", "key").agg(
        F.max_by(F.struct("value"), "seq").alias("_value"), F.max("seq").alias("seq")
    )
    entries = latest.select("device", "seq", "section", "key", F.col("_value.value").alias("value"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_path(f"{path}/patches", batch_id))

    return entries.writeStream.outputMode("update").foreachBatch(write)


def stream_device_versions(sdf: DataFrame, path: str):
    """A writer of how many patches a micro-batch had per device, below path/versions; their sum is the version.

    The rows of one patch have to come together.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        state_versions(batch).write.mode("overwrite").parquet(_batch_path(f"{path}/versions", batch_id))

    return sdf.writeStream.foreachBatch(write)


# ── device documents ─────────────────────────────────────────────────────────────


class _DeviceState(StatefulProcessor):
    """State: the document of the device and its version."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.doc = handle.getValueState(
            "doc",
            T.StructType([T.StructField("state", T.StringType()), T.StructField("version", T.LongType())]),
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = ["device", "seq", "patch", "stated_version"]
        pdf = pd.concat([r[columns] for r in rows]).sort_values("seq", kind="stable")
        text, version = self.doc.get() if self.doc.exists() else ("{}", 0)
        state, out = json.loads(text), []
        for row in pdf.itertuples(index=False):
            stated = row.stated_version
            ok = pd.isna(stated) or int(stated) == version
            if ok:
                for section, patch in json.loads(row.patch).items():
                    if patch is None:
                        state.pop(section, None)
                        continue
                    held = state.setdefault(section, {})
                    held.update(patch)
                    state[section] = {k: v for k, v in held.items() if v is not None}
                version += 1
            out.append((row.device, row.seq, bool(ok), version, json.dumps(state, sort_keys=True)))
        self.doc.update((json.dumps(state), version))
        yield pd.DataFrame(out, columns=["device", "seq", "accepted", "version", "state"])

    def close(self) -> None:
        pass


def stream_device_documents(sdf: DataFrame) -> DataFrame:
    """The document of a device after every patch, as (device, seq, accepted, version, state).

    A patch row has device, seq, patch (JSON of sections) and stated_version: if that
    is given it must equal the current version, else the patch is refused.
    """
    schema = "device string, seq bigint, accepted boolean, version bigint, state string"
    return sdf.groupBy("device").transformWithStateInPandas(
        _DeviceState(), T._parse_datatype_string(schema), outputMode="Append", timeMode="None"
    )
