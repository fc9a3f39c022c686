from __future__ import annotations

import json
import os
import pickle
import random
import time
import tracemalloc
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lumenloom.functions import json_paths as jp
from lumenloom.operators import changes, devices, patterns, routing
from lumenloom.sources import connectors, positions
from lumenloom.streaming import flows, runs, stateful


@pytest.fixture
def feed(spark, tmp_path):
    """Writes micro-batches as files that arrive one after the other, and reads them one per trigger."""

    def make(batches, schema):
        place = tmp_path / "feed"
        place.mkdir()
        for i, batch in enumerate(batches):
            part = tmp_path / f"part{i}"
            spark.createDataFrame(batch, schema).coalesce(1).write.parquet(str(part))
            (file,) = [f for f in os.listdir(part) if f.endswith(".parquet")]
            target = place / f"{i}.parquet"
            os.link(part / file, target)
            os.utime(target, (time.time() - 1000 + i * 10,) * 2)
        return runs.read_stream(spark, str(place), files_per_trigger=1)

    return make


def test_routes_and_enrichment(spark, feed, tmp_path, rows):
    sdf = feed([[(1, "a"), (2, "b")], [(3, "a"), (4, "z")]], "id int, kind string")
    path = str(tmp_path / "out")
    known = spark.createDataFrame([("a", "A!")], "kind string, name string")
    routes = {"small": F.col("id") < 4, "named": F.col("name").isNotNull()}
    runs.finish(flows.route_stream(sdf, routes, path, known, "kind"), spark, "r")
    got = spark.read.parquet(path)
    assert rows(got, "route", "id") == [("named", 1), ("named", 3), ("small", 1), ("small", 2), ("small", 3)]


def test_bad_records_go_to_the_dead_letters(spark, feed, tmp_path, rows):
    sdf = feed([[('{"k":1}',), ("{bad",)], [('{"k":2}',)]], "v string")
    path = str(tmp_path / "out")
    runs.finish(flows.dead_letter_stream(sdf, jp.at(jp.parse(F.col("v")), ["k"], "int"), path), spark, "d")
    got = spark.read.parquet(path)
    assert rows(got, "outcome", "v") == [("dead_letter", "{bad"), ("ok", '{"k":1}'), ("ok", '{"k":2}')]


def test_delivery_by_hour(spark, feed, tmp_path):
    sdf = feed([[("a\n", 0), ("b", 3599)], [("c", 3600)]], "v string, s long")
    path = str(tmp_path / "out")
    runs.finish(flows.deliver(sdf, F.col("v"), F.timestamp_seconds("s"), path), spark, "n")
    texts = {}
    for base, _, names in os.walk(path):
        for n in names:
            if n.endswith(".txt"):
                key = base.split("batch=")[1].split("/", 1)[1]
                with open(os.path.join(base, n)) as f:
                    texts.setdefault(key, []).extend(f.read().splitlines())
    assert {k: sorted(v) for k, v in texts.items()} == {
        "year=1970/month=01/day=01/hour=00": ["a", "b"],
        "year=1970/month=01/day=01/hour=01": ["c"],
    }


def test_batch_delivery(spark, tmp_path):
    df = spark.createDataFrame([("x", 5)], "v string, s long")
    flows.deliver(df, F.col("v"), F.timestamp_seconds("s"), str(tmp_path / "o"))
    assert spark.read.text(str(tmp_path / "o")).count() == 1


METRIC = "s long, value double, sample_count double, sum double, minimum double, maximum double"


def test_metrics_drop_what_comes_past_the_watermark(spark, feed):
    row = lambda s, v: (s, v, 0.0, 0.0, 0.0, 0.0)
    sdf = feed([[row(5, 1.0), row(30, 3.0)], [row(200, 9.0)], [row(210, 1.0)], [row(40, 100.0), row(400, 5.0)]], METRIC)
    timed = sdf.withColumn("ts", F.timestamp_seconds("s"))
    stats = stateful.stream_metrics(timed, "ts", 60, "30 seconds")
    got = {r.period_start: (r.sample_count, r.sum, r.average, r.minimum, r.maximum) for r in runs.stream_to_table(stats, "m").collect()}
    assert got == {0: (2.0, 4.0, 2.0, 1.0, 3.0), 180: (2.0, 10.0, 5.0, 1.0, 9.0)}


def stored(spark, checkpoint, variable):
    """What Spark's state store holds at the end, by key."""
    return spark.read.format("statestore").option("stateVarName", variable).load(str(checkpoint))


def finish(writer, checkpoint):
    writer.option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start().awaitTermination()


def seconds(df):
    return sorted((r.k, r.s) for r in df.collect())


def test_deduplication_remembers_across_batches(spark, feed, tmp_path):
    times = [[0, 100, 299], [301, 500, 600], [], [601, 602, 90], [5000]]
    batches = [[("a", t, i) for i, t in enumerate(b)] + ([("b", 100, 9)] if n == 1 else []) for n, b in enumerate(times) if b]
    sdf = feed(batches, "k string, s long, i int").withColumn("ts", F.timestamp_seconds("s"))
    path = str(tmp_path / "out")
    finish(stateful.stream_fifo_dedup(sdf, ["k"], "ts", path, 300, ["i"], keep_seconds=3000), tmp_path / "ck")
    got = seconds(spark.read.parquet(f"{path}/rows"))
    assert got == [("a", 0), ("a", 301), ("a", 601), ("a", 5000), ("b", 100)]
    state = stored(spark, tmp_path / "ck", "accepted").select("key.k")
    assert {r.k for r in state.collect()} == {"a"}  # b is past what is kept


def test_late_rows_are_accepted_as_in_one_batch(spark, feed, tmp_path):
    """Rows far behind what is accepted are accepted; one that would have shadowed such a row is reported."""
    batches = [[("a", 10000, 0), ("n", None, 1)], [("a", 100, 2), ("a", 399, 3), ("n", None, 4)], [("a", 9800, 5), ("a", 9700, 6), ("a", 10299, 7)]]
    sdf = feed(batches, "k string, s long, i int").withColumn("ts", F.timestamp_seconds("s"))
    path = str(tmp_path / "out")
    finish(stateful.stream_fifo_dedup(sdf, ["k"], "ts", path, 300, ["i"]), tmp_path / "ck")
    got, late = (spark.read.parquet(f"{path}/{x}") for x in ("rows", "late"))
    assert seconds(got.where("s IS NOT NULL")) == [("a", 100), ("a", 9700), ("a", 10000)]
    assert [(r.k, r.i) for r in got.where("s IS NULL").collect()] == [("n", 1)]
    assert seconds(late) == []
    whole = spark.createDataFrame([r for b in batches for r in b], "k string, s long, i int").withColumn("ts", F.timestamp_seconds("s"))
    assert sorted(r.i for r in changes.fifo_dedup(whole, ["k"], "ts", 300, ["i"]).collect()) == sorted(r.i for r in got.collect())


def test_a_busy_key_is_held_as_its_times(spark, feed, tmp_path):
    """Many rows of one key, some of one instant in many blocks, need little more memory than their times."""
    r = random.Random(31)
    whole = [(r.randrange(3000), i) for i in range(4000)] + [(None, i) for i in range(3)]
    path = str(tmp_path / "out")
    sdf = feed([[("a", s, i, b"x") for s, i in part] for part in (whole[::2], whole[1::2])], "k string, s long, i int, b binary").withColumn("ts", F.timestamp_seconds("s"))
    finish(stateful.stream_fifo_dedup(sdf, ["k"], "ts", path, 7, ["i"]), tmp_path / "ck")
    # a plain scan, batch after batch
    accepted, want, late = [], [], []
    for n, part in enumerate((whole[::2], whole[1::2])):
        firsts = {}
        for s, i in part:
            firsts[s] = min(i, firsts.get(s, i))
        want += [(None, firsts.pop(None))] if n == 0 and None in firsts else []
        firsts.pop(None, None)
        for s in sorted(firsts):
            if not any(a <= s < a + 7 for a in accepted):
                if any(s < a < s + 7 for a in accepted):
                    late.append((s, firsts[s]))
                else:
                    accepted.append(s)
                    want.append((s, firsts[s]))
    got, gone = ([(x.s, x.i) for x in spark.read.parquet(f"{path}/{p}").collect()] for p in ("rows", "late"))
    assert sorted(got, key=str) == sorted(want, key=str) and sorted(gone) == sorted(late)

    blocks = stateful._Blocks()
    tracemalloc.start()
    for i in range(100_000):
        blocks.add(i % 90_000, (True, i), (i, "x" * 500))
    times, count = blocks.instants()
    assert tracemalloc.get_traced_memory()[1] < 40 << 20
    tracemalloc.stop()
    some = np.array([5, 50, 89_999])
    assert sorted((t, v[0]) for t, v in blocks.firsts(some, count[some])) == [(5, 5), (50, 50), (89_999, 89_999)]


class _Held(dict):
    """A map state of one key, with its calls counted."""

    calls = 0

    def getMapState(self, *args):
        return self

    def exists(self):
        return bool(self)

    def containsKey(self, key):
        self.calls += 1
        return key in self

    def getValue(self, key):
        self.calls += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value


def test_a_busy_key_leaves_and_is_kept_in_pieces():
    """What a key gives in one batch is held as bytes, and its state is asked for once in many windows."""
    n, state = 60_000, _Held()
    rows = lambda: (Row(s=i, _t=i * 10_000_000, _order=(i,)) for i in range(n))
    decide = stateful._FirstAccepted(7_000_000, ["s"], None)
    decide.init(state)
    tracemalloc.start()
    out = list(decide.handleInputRows(("a",), rows(), None))
    assert tracemalloc.get_traced_memory()[1] < 14 << 20
    tracemalloc.stop()
    assert [r for x in out for r in pickle.loads(x._packed)] == [(i, False) for i in range(n)]
    assert state.calls < n // 20
    assert list(decide.handleInputRows(("a",), rows(), None)) == []


def test_deduplicated_rows_keep_their_types(spark, feed, tmp_path, rows):
    columns = "k string, s long, ts timestamp, d decimal(20,2), n struct<a: long, b: array<double>>, b binary"
    whole = [("a" if i % 3 else None, i * 40 if i % 5 else None, None, Decimal(i) / 4, (None if i % 2 else 2**60 + i, [0.5, None]), bytes([i])) for i in range(40)]
    sdf = feed([whole], columns).withColumn("ts", F.timestamp_seconds("s"))
    path = str(tmp_path / "out")
    finish(stateful.stream_fifo_dedup(sdf, ["k"], "ts", path, 300, ["d"]), tmp_path / "ck")
    twin = changes.fifo_dedup(spark.createDataFrame(whole, columns).withColumn("ts", F.timestamp_seconds("s")), ["k"], "ts", 300, ["d"])
    got = spark.read.parquet(f"{path}/rows").drop("batch")
    assert got.schema == sdf.schema and rows(got) == rows(twin.select(*got.columns))


def test_rows_that_come_too_late_are_told(spark, feed, tmp_path):
    batches = [[("a", 10000), ("b", 20000)], [("a", 9800)], [("a", 30000)], [("a", 100), ("a", 29000), ("c", 50)]]
    sdf = feed(batches, "k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    path = str(tmp_path / "out")
    finish(stateful.stream_fifo_dedup(sdf, ["k"], "ts", path, 300, keep_seconds=2000), tmp_path / "ck")
    assert seconds(spark.read.parquet(f"{path}/rows")) == [("a", 10000), ("a", 29000), ("a", 30000), ("b", 20000)]
    # 9800 is behind the watermark of its batch already, as are 100 and 50 later
    assert seconds(spark.read.parquet(f"{path}/late")) == [("a", 100), ("a", 9800), ("c", 50)]


def test_change_stream_equals_the_batch_twin(spark, feed, tmp_path):
    versions = [("a", 1, "x"), ("b", 2, "p"), ("a", 3, "y"), ("a", 4, "z"), ("b", 5, "q"), ("c", 6, None)]
    sdf = feed([versions[:2], versions[2:4], versions[4:]], "k string, seq long, v string")
    path = str(tmp_path / "out")
    runs.finish(stateful.stream_cdc(sdf, ["k"], "seq", path, 2), spark, "c")
    whole = spark.createDataFrame(versions, "k string, seq long, v string")
    columns = ["k", "seq", "event_name", "new_image.v", "old_image.v"]
    twin = changes.cdc_images(whole, ["k"], "seq")
    got = spark.read.parquet(f"{path}/events")
    key = lambda df: sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: r[1])
    assert key(got) == key(twin) and len(key(got)) == 6


VERSION = "k string, seq long, v string, gone boolean"


@pytest.mark.parametrize("width", [1, 3, 100])
def test_late_versions_and_removals_equal_the_batch_twin(spark, feed, tmp_path, width):
    """Versions in any order over four micro-batches, with removals before and behind them, and repeats."""
    r = random.Random(width)
    versions = [(k, s, f"{k}{s}", r.random() < 0.3) for k in "abc" for s in r.sample(range(20), 12)] + [("d", 5, None, True)]
    r.shuffle(versions)
    batches = [versions[i::4] for i in range(4)]
    batches[2] += versions[:3]  # come again
    path = str(tmp_path / "out")
    writer = stateful.stream_cdc(feed(batches, VERSION), ["k"], "seq", path, width, deleted=F.col("gone"))
    finish(writer, tmp_path / "ck")
    whole = spark.createDataFrame(versions, VERSION)
    columns = ["k", "seq", "event_name", "new_image.v", "old_image.v"]
    twin = changes.cdc_images(whole, ["k"], "seq", deleted=F.col("gone"))
    events = spark.read.parquet(f"{path}/events")
    got = stateful.latest_events(events, ["k"], "seq")
    key = lambda df: sorted((tuple(x) for x in df.select(*columns).collect()), key=lambda x: x[:2])
    assert key(got) == key(twin)
    assert events.where("revision > 0").count() > 0
    assert spark.read.parquet(f"{path}/late").count() == 0


def test_keys_share_the_entries_of_their_cell(spark, feed, tmp_path):
    """Many keys, also null, zeros of both signs and not-a-numbers, are kept in few entries and stay apart."""
    r = random.Random(5)
    named = [None, 0.0, -0.0, float("nan"), *map(float, range(1, 60))]
    versions = [(r.choice(named), s, f"v{s}", r.random() < 0.2) for s in range(400)]
    r.shuffle(versions)
    schema = "k double, seq long, v string, gone boolean"
    path = str(tmp_path / "out")
    writer = stateful.stream_cdc(feed([versions[:250], versions[250:]], schema), ["k"], "seq", path, 100, deleted=F.col("gone"), cells=3)
    finish(writer, tmp_path / "ck")
    twin = changes.cdc_images(spark.createDataFrame(versions, schema), ["k"], "seq", deleted=F.col("gone"))
    got = stateful.latest_events(spark.read.parquet(f"{path}/events"), ["k"], "seq")
    columns = ["seq", "event_name", "new_image.v", "old_image.v"]
    key = lambda df: sorted(str(x.k + 0.0 if x.k is not None else None) + str(tuple(x)[1:]) for x in df.select("k", *columns).collect())
    assert key(got) == key(twin)
    assert stored(spark, tmp_path / "ck", "versions").count() == 3 * 4


def test_versions_past_what_is_kept_are_told(spark, feed, tmp_path):
    batches = [[("a", 1, "x", False), ("a", 50, "y", False)], [("a", 2, "late", False), ("a", 45, "back", False), ("a", 51, "z", False)]]
    path = str(tmp_path / "out")
    finish(stateful.stream_cdc(feed(batches, VERSION), ["k"], "seq", path, 5, "NEW_IMAGE", keep=10), tmp_path / "ck")
    events = spark.read.parquet(f"{path}/events")
    assert sorted((r.seq, r.event_name, r.revision, r.new_image.v, r.old_image) for r in events.collect()) == [
        (1, "INSERT", 0, "x", None), (45, "INSERT", 0, "back", None), (50, "MODIFY", 0, "y", None), (50, "MODIFY", 1, "y", None), (51, "MODIFY", 0, "z", None),
    ]
    assert [(r.seq, r.new_image.v) for r in spark.read.parquet(f"{path}/late").collect()] == [(2, "late")]
    kept = stored(spark, tmp_path / "ck", "versions").selectExpr("user_map_key.chunk AS c")
    assert min(r.c for r in kept.collect()) >= 8


PATCH = "device string, seq long, section string, key string, value string"


def test_device_state_stream(spark, feed, tmp_path, rows):
    data = [
        [("d", 1, "desired", "a", "1"), ("d", 2, "desired", "b", "2"), ("e", 1, "reported", "x", "1")],
        [("d", 4, "desired", "a", "back"), ("e", 2, "reported", None, None)],
        [("d", 3, "desired", "a", None), ("e", 3, "reported", "y", "2")],  # 3 comes after 4
    ]
    path = str(tmp_path / "out")
    runs.finish(stateful.stream_device_state(feed(data, PATCH), path), spark, "s")
    patches = spark.read.parquet(f"{path}/patches")
    whole = spark.createDataFrame([r for b in data for r in b], PATCH)
    assert rows(devices.merge_state(patches)) == rows(devices.merge_state(whole)) == [
        ("d", "desired", "a", "back"), ("d", "desired", "b", "2"), ("e", "reported", "y", "2"),
    ]
    # a micro-batch writes the entries it touches, and no others
    written = patches.groupBy("batch").agg(F.collect_set(F.concat_ws(".", "device", "section", "key")).alias("e"))
    assert {r.batch: sorted(r.e) for r in written.collect()} == {
        0: ["d.desired.a", "d.desired.b", "e.reported.x"], 1: ["d.desired.a", "e.reported"], 2: ["d.desired.a", "e.reported.y"],
    }


def test_device_versions_stream(spark, feed, tmp_path, rows):
    data = [[("d", 1, "s", "a", "1"), ("d", 1, "s", "b", "1"), ("e", 1, "s", "a", "1")], [("d", 2, "s", "a", "2")]]
    path = str(tmp_path / "out")
    runs.finish(stateful.stream_device_versions(feed(data, PATCH), path), spark, "v")
    total = spark.read.parquet(f"{path}/versions").groupBy("device").agg(F.sum("version"))
    assert rows(total) == [("d", 2), ("e", 1)]


def test_documents_refuse_a_wrong_version(spark, feed):
    patch = lambda **kw: json.dumps(kw)
    data = [
        [("d", 1, patch(desired={"a": 1, "b": 2}), None), ("d", 2, patch(desired={"a": None}, reported={"r": 1}), 1)],
        [("d", 3, patch(desired={"c": 3}), 1), ("d", 4, patch(reported=None), 2)],
    ]
    sdf = feed(data, "device string, seq long, patch string, stated_version long")
    got = {r.seq: r for r in runs.stream_to_table(stateful.stream_device_documents(sdf), "docs").collect()}
    assert {s: (r.accepted, r.version) for s, r in got.items()} == {1: (True, 1), 2: (True, 2), 3: (False, 2), 4: (True, 3)}
    assert json.loads(got[2].state) == {"desired": {"b": 2}, "reported": {"r": 1}}
    assert json.loads(got[4].state) == {"desired": {"b": 2}}


def test_archive_stream_feeds_a_replay(spark, feed, tmp_path):
    schema = "bus string, source string, detail string, s long"
    sdf = feed([[("default", "a", '{"x":1}', 10)], [("default", "b", None, 20), ("default", "a", "{}", 90000)]], schema)
    timed = sdf.withColumn("event_time", F.timestamp_seconds("s"))
    path = str(tmp_path / "arch")
    kept = patterns.match_event(timed, {"source": ["a", "b"]})
    runs.finish(flows.archive_stream(kept, path, "event_time"), spark, "a")
    again = routing.replay(spark.read.parquet(path), "1970-01-01 00:00:10", "1970-01-01 00:00:20")
    assert [(r.source, r.detail) for r in again.collect()] == [("a", '{"x":1}'), ("b", "{}")]


def test_a_failing_stream_raises(spark, feed):
    sdf = feed([[(1,)]], "id int").select(F.raise_error(F.lit("stop here")).alias("x"))
    with pytest.raises(Exception, match="stop here"):
        runs.finish(sdf.writeStream.format("noop"), spark, "x", timeout=60)


def test_kafka_records_are_decoded(spark, rows):
    raw = spark.createDataFrame(
        [("t", 0, 5, None, bytearray(b"k"), bytearray("é".encode()))],
        "topic string, partition int, offset long, timestamp timestamp, key binary, value binary",
    )
    assert rows(connectors.decode_records(raw), "key", "value") == [("k", "é")]


def test_read_positions(spark):
    df = spark.range(10).select(F.col("id").alias("sequence_number"), F.timestamp_seconds(F.col("id") * 10).alias("arrival"))

    def run(*args):
        return [r.sequence_number for r in positions.read_from(df, *args).collect()]

    assert run("OLDEST", None, 3) == [0, 1, 2]
    assert run("NEWEST") == []
    assert run("AT_SEQUENCE", 7) == [7, 8, 9]
    assert run("AFTER_SEQUENCE", 7) == [8, 9]
    assert run("AT_TIMESTAMP", F.timestamp_seconds(F.lit(75))) == [8, 9]
    lag = lambda page: positions.read_lag(df, page).first().millis_behind
    assert lag(positions.read_from(df, "OLDEST", None, 3)) == 70_000
    assert lag(positions.read_from(df, "OLDEST")) == 0
    assert lag(positions.read_from(df, "NEWEST")) == 0
    with pytest.raises(ValueError):
        run("SOMEWHERE")


def test_listing(spark, rows):
    keys = ["a/1", "a/2", "a/b/3", "b", "c/x", "a"]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    assert rows(positions.list_prefixes(df)) == [("a", False), ("a/", True), ("b", False), ("c/", True)]
    assert rows(positions.list_prefixes(df, "a/")) == [("a/1", False), ("a/2", False), ("a/b/", True)]
    assert rows(positions.list_prefixes(df, after="a/", max_keys=1)) == [("b", False)]
    assert len(rows(positions.list_prefixes(df, delimiter=None))) == 6


def test_a_stream_reads_its_own_table_only(spark, tmp_path):
    base = str(tmp_path)
    spark.range(3).coalesce(1).write.parquet(f"{base}/orders")
    spark.range(5).coalesce(1).write.parquet(f"{base}/orders_old")
    assert runs.stream_to_table(runs.read_stream(spark, f"{base}/orders"), "own-folder").count() == 3
    # single files beside each other, one of which has the other's name in front of its own
    for name, folder in (("t.parquet", "orders"), ("t.parquet_old", "orders_old")):
        part = next(p for p in (tmp_path / folder).iterdir() if p.name.startswith("part-"))
        (tmp_path / name).write_bytes(part.read_bytes())
    assert runs.stream_to_table(runs.read_stream(spark, f"{base}/t.parquet"), "own-file").count() == 3


def test_exact_sums_of_number_text(spark):
    from lumenloom.functions.numbers import decimal_add, decimal_subtract

    cases = [("1e-16", "1", "1.0000000000000001"), ("0.1", "0.2", "0.3"), ("99999999999999999999999999", "1", "1" + "0" * 26), ("5", "x", None)]
    df = spark.createDataFrame(cases, "a string, b string, want string")
    for r in df.select("want", decimal_add(F.col("a"), F.col("b")).alias("got")).collect():
        assert r.got == r.want
    assert df.select(decimal_subtract(F.col("a"), F.col("b")).alias("d")).first().d == "-0.9999999999999999"
