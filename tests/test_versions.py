from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from lumenloom.operators import changes, devices, ordered


def greedy(times, window):
    taken, last = [], None
    for t in sorted(set(times)):
        if last is None or t >= last + window:
            taken.append(t)
            last = t
    return taken


def stamped(spark, pairs):
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(pairs)], "k string, s double, i long")
    return df.withColumn("ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint")))


def accepted(df, **kw):
    out = changes.fifo_dedup(df, ["k"], "ts", 300, ["i"], **kw)
    got = {}
    for r in out.select("k", "s").collect():
        got.setdefault(r.k, []).append(r.s)
    return {k: sorted(v) for k, v in got.items()}


def test_repeats_count_from_the_accepted_message(spark):
    times = [0, 100, 299, 301, 500, 601, 602]
    assert accepted(stamped(spark, [("a", float(t)) for t in times])) == {"a": [0, 301, 601]}
    assert accepted(stamped(spark, [("a", 0.0), ("a", 300.0), ("b", 100.0)])) == {"a": [0, 300], "b": [100]}


@pytest.mark.parametrize(("spread", "tasks"), [(2_000, 40), (20_000, 40), (20_000, 7), (200_000, 150), (90_000, 1), (90_000, 3)])
def test_tasks_agree_with_one_pass_per_key(spark, spread, tasks):
    rng = random.Random(spread + tasks)
    pairs = [("hot", round(rng.uniform(-1000, spread), 3)) for _ in range(900)]
    pairs += [(f"k{rng.randrange(20)}", float(rng.randrange(spread))) for _ in range(400)]
    # a steady beat, whose chains from different starts never meet
    pairs += [("beat", float(t)) for t in range(0, min(spread, 9000), 7)]
    want = {}
    for k, t in pairs:
        want.setdefault(k, []).append(t)
    want = {k: greedy(v, 300) for k, v in want.items()}
    assert accepted(stamped(spark, pairs), tasks=tasks) == want


def test_one_key_of_nine_tenths_spreads_over_tasks(spark):
    """A busy key in 120 tasks: the step functions are composed in a tree of two levels."""
    rng = random.Random(1)
    pairs = [("hot", t / 10) for t in rng.sample(range(200_000), 4_500)] + [(f"k{i % 50}", float(rng.randrange(20_000))) for i in range(500)]
    times = {}
    for k, t in pairs:
        times.setdefault(k, []).append(t)
    assert accepted(stamped(spark, pairs), tasks=120) == {k: greedy(v, 300) for k, v in times.items()}


def test_close_keys_and_missing_times(spark):
    """Keys a microsecond apart are two keys; a null is a key; rows without a time are one instant of their key."""
    rows = [(0, 1, 1, 0), (1, 1, 2, 10), (0, 1, 3, 10), (None, 1, 4, 5), (None, 1, 5, 305), (None, 1, 6, 200), (0, 1, 7, None), (0, 1, 8, None), (0, 2, 9, 20), (1, 1, 10, None)]
    df = spark.createDataFrame(rows, "k long, g int, i long, s long").select(F.timestamp_micros("k").alias("k"), "g", "i", F.timestamp_seconds("s").alias("ts"))
    got = sorted(r.i for r in changes.fifo_dedup(df, ["k", "g"], "ts", 300, ["i"], tasks=5).collect())
    assert got == [1, 2, 4, 5, 7, 9, 10]
    assert changes.fifo_dedup(df.limit(0), ["k"], "ts").count() == 0


def test_one_row_per_instant(spark):
    df = stamped(spark, [("a", 5.0), ("a", 5.0), ("a", 5.0)])
    assert [r.i for r in changes.fifo_dedup(df, ["k"], "ts", 300, ["i"]).collect()] == [0]


def test_content_ids(spark):
    assert spark.range(1).select(changes.content_id(F.lit("x")).alias("h")).first().h == "9dd4e461268c8034f5c8564e155c67a6"


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_previous_next_and_totals_cross_tasks(spark, tasks):
    rng = random.Random(tasks)
    data = [(None if k == 2 else f"k{k}", i, None if i % 5 == 0 else i * 10, i / 4) for i in rng.sample(range(200), 120) for k in [rng.choice([0, 0, 0, 0, 1, 2])]]
    df = spark.createDataFrame(data, "k string, i long, v long, w double")
    out = ordered.with_neighbours(
        df, ["k"], ["i"], {"p": F.col("v"), "ps": F.struct("i", "v")}, {"n": F.col("v")}, {"t": F.col("v"), "f": F.col("w"), "r": F.lit(1)}, tasks
    )
    got = {(r.k, r.i): (r.p, r.ps and tuple(r.ps), r.n, r.t, r.f, r.r) for r in out.collect()}
    assert len(got) == len(data) and out.columns == ["k", "i", "v", "w", "p", "ps", "n", "t", "f", "r"]
    for k in {d[0] for d in data}:
        mine, total, floats = sorted((d for d in data if d[0] == k), key=lambda d: d[1]), 0, 0.0
        for j, (_, i, v, w) in enumerate(mine):
            total, floats = total + (v or 0), floats + w
            p = mine[j - 1] if j else (None,) * 4
            n = mine[j + 1][2] if j + 1 < len(mine) else None
            assert got[k, i] == (p[2], p[1:3] if j else None, n, total, pytest.approx(floats), j + 1)
    assert ordered.with_neighbours(df.limit(0), ["k"], ["i"], {"p": F.col("v")}).count() == 0


def test_one_key_over_many_tasks_takes_one_pass(spark):
    """All rows of one key: every task but the edges holds nothing else."""
    df = spark.range(5000).select(F.lit("hot").alias("k"), "id", (F.col("id") * 0 + 2).alias("v"))
    out = ordered.with_neighbours(df, ["k"], ["id"], {"p": F.col("id")}, {"n": F.col("id")}, {"t": F.col("v")}, 64)
    wrong = "t <> 2 * (id + 1) OR coalesce(p, -1) <> id - 1 OR coalesce(n, 5000) <> id + 1"
    assert out.count() == 5000 and out.where(wrong).count() == 0


def test_change_events(spark):
    data = [("a", 1, "x", False), ("a", 2, "y", False), ("a", 3, None, True), ("a", 4, "z", False), ("b", 9, None, True)]
    df = spark.createDataFrame(data, "k string, seq long, v string, gone boolean")

    def run(view):
        out = changes.cdc_images(df, ["k"], "seq", view, F.col("gone"))
        return [
            (r.seq, r.event_name, r.new_image and r.new_image.v, r.old_image and r.old_image.v)
            for r in out.orderBy("seq").collect()
        ]

    assert run("NEW_AND_OLD_IMAGES") == [
        (1, "INSERT", "x", None), (2, "MODIFY", "y", "x"), (3, "REMOVE", None, "y"), (4, "INSERT", "z", None),
    ]
    assert run("KEYS_ONLY") == [(1, "INSERT", None, None), (2, "MODIFY", None, None), (3, "REMOVE", None, None), (4, "INSERT", None, None)]
    assert run("OLD_IMAGE")[1] == (2, "MODIFY", None, "x")
    assert run("NEW_IMAGE")[1] == (2, "MODIFY", "y", None)


def test_upsert_prefers_new_rows_on_a_tie(spark, rows):
    old = spark.createDataFrame([("a", 1, "old"), ("b", 5, "old")], "k string, s long, v string")
    new = spark.createDataFrame([("a", 1, "new"), ("b", 4, "new"), ("c", 1, "new")], "k string, s long, v string")
    assert rows(changes.upsert_latest(old, new, ["k"], "s"), "k", "v") == [("a", "new"), ("b", "old"), ("c", "new")]


def test_updates(spark, rows):
    base = spark.createDataFrame([("a", "x", 1, ["p"]), ("b", "y", 2, None), ("c", "z", 3, None), ("d", "w", 4, None)], "k string, s string, n int, l array<string>")
    change = spark.createDataFrame(
        [("a", "update", "X", 10, ["q"]), ("b", "delete", None, None, None), ("c", "put", None, 7, None), ("e", "update", "new", 5, None), ("f", "delete", None, None, None)],
        "k string, op string, s string, n int, l array<string>",
    )
    out = changes.apply_updates(base, change, ["k"], ["s"], ["n"], ["l"])
    assert rows(out) == [("a", "X", 11, ["p", "q"]), ("c", None, 7, None), ("d", "w", 4, None), ("e", "new", 5, None)]
    # a condition is about the row that is there
    out = changes.apply_updates(base, change, ["k"], ["s"], ["n"], ["l"], condition=F.col("n") > 1)
    assert [r[:3] for r in rows(out)] == [("a", "x", 1), ("c", None, 7), ("d", "w", 4)]
    out = changes.apply_updates(base, change, ["k"], set_if_missing=["s", "l"])
    assert ("a", "x", 1, ["p"]) in rows(out)


def test_versions_close_each_other(spark, rows):
    df = spark.createDataFrame([("t", 10), ("t", 20), ("u", 5)], "k string, at long")
    out = changes.versions(df, ["k"], "at")
    assert rows(out, "k", "at", "version", "valid_to", "is_current") == [
        ("t", 10, 1, 20, False), ("t", 20, 2, None, True), ("u", 5, 1, None, True),
    ]


PATCH = "device string, seq long, section string, key string, value string"


def test_device_state(spark, rows):
    data = [
        ("d", 1, "desired", "a", "1"),
        ("d", 1, "desired", "b", "2"),
        ("d", 2, "desired", "a", None),
        ("d", 3, "reported", "a", "9"),
        ("d", 4, "reported", None, None),
        ("d", 5, "reported", "c", "3"),
        ("d", 6, "desired", "a", "again"),
        ("e", 1, "desired", "x", None),
    ]
    patches = spark.createDataFrame(data, PATCH)
    assert rows(devices.merge_state(patches)) == [("d", "desired", "a", "again"), ("d", "desired", "b", "2"), ("d", "reported", "c", "3")]
    docs = {r.device: r for r in devices.state_documents(patches).collect()}
    assert docs["d"].version == 6 and json.loads(docs["d"].state["desired"]) == {"a": "again", "b": "2"}
    assert docs["e"].version == 1 and docs["e"].state is None
