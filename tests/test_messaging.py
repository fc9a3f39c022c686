from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lumenloom.operators import patterns as pt
from lumenloom.operators import reshape, routing


def one(spark, text, test):
    df = spark.createDataFrame([(text,)], "j string")
    return test(df).count() == 1


# ── records ──────────────────────────────────────────────────────────────────────

RECORD = {
    "body": json.dumps({"kind": "order", "total": 12.5, "deep": {"x": "Y"}}),
    "name": "Alpha",
    "n": 100,
    "zero": 0.0,
    "nil": None,
    "flag": True,
    "list": ["a"],
}


@pytest.mark.parametrize(
    ("pattern", "want"),
    [
        ({"name": ["Alpha"]}, True),
        ({"name": ["Beta", {"prefix": "Al"}]}, True),
        ({"name": [{"suffix": "ha"}]}, True),
        ({"name": [{"equals-ignore-case": "ALPHA"}]}, True),
        ({"name": [{"anything-but": ["Alpha"]}]}, False),
        ({"name": [{"anything-but": "Beta"}]}, True),
        ({"name": [{"anything-but": {"prefix": "Al"}}]}, False),
        ({"missing": [{"anything-but": ["x"]}]}, True),
        ({"missing": [{"anything-but": {"prefix": "x"}}]}, True),
        ({"nil": [{"anything-but": "x"}]}, True),
        ({"n": [{"anything-but": {"prefix": "x"}}]}, False),
        ({"n": [{"anything-but": [100]}]}, False),
        ({"missing": [{"exists": False}]}, True),
        ({"nil": [{"exists": False}]}, True),
        ({"nil": [None]}, True),
        ({"name": [{"exists": True}]}, True),
        ({"n": [100.0]}, True),
        ({"zero": [0]}, True),
        ({"n": ["100"]}, False),
        ({"n": [{"numeric": ["=", 100]}]}, True),
        ({"n": [{"numeric": [">", 0, "<=", 100]}]}, True),
        ({"n": [{"numeric": [">", 100]}]}, False),
        ({"name": [{"numeric": [">", 0]}]}, False),
        ({"body": {"kind": ["order"], "deep": {"x": ["Y"]}}}, True),
        ({"body": {"kind": ["refund"]}}, False),
        ({"name": {"x": ["y"]}}, False),
        ({"missing": {"x": [{"exists": False}]}}, True),
        ({"name": "Alpha"}, False),
        ({"flag": [True]}, False),
        ({"name": ["Alpha"], "n": [1]}, False),
    ],
)
def test_record_patterns(spark, pattern, want):
    assert one(spark, json.dumps(RECORD), lambda df: pt.match_record(df, [pattern], "j")) is want


def test_record_filters_are_alternatives(spark):
    text = json.dumps(RECORD)
    assert one(spark, text, lambda df: pt.match_record(df, [{"n": [1]}, '{"n":[100]}'], "j"))
    assert one(spark, text, lambda df: pt.match_record(df, [], "j"))


# ── bus events ───────────────────────────────────────────────────────────────────


def bus(spark, detail, **kw):
    row = {"source": "my.app", "detail_type": "T", "account": "1", "region": "r", "resources": ["arn:a", "arn:b"], "bus": "default"}
    row = {**row, **kw}
    schema = "source string, detail_type string, account string, region string, resources array<string>, bus string, detail string"
    return spark.createDataFrame([(*row.values(), detail)], schema)


DETAIL = json.dumps({"s": "abc", "n": 5, "nil": None, "o": {"x": "y"}, "t": json.dumps({"q": "z"})})


@pytest.mark.parametrize(
    ("pattern", "want"),
    [
        ({}, True),
        ({"source": ["my.app"], "detail-type": ["T"]}, True),
        ({"source": [{"prefix": "my."}], "region": ["x"]}, False),
        ({"detail": {"s": [{"suffix": "bc"}]}}, True),
        ({"detail": {"n": ["5"]}}, True),
        ({"detail": {"n": [5]}}, False),
        ({"detail": {"missing": [{"anything-but": ["x"]}]}}, False),
        ({"detail": {"s": [{"anything-but": ["x"]}]}}, True),
        ({"detail": {"s": [{"anything-but": {"prefix": "a"}}]}}, False),
        ({"detail": {"nil": [None], "missing": [None]}}, True),
        ({"detail": {"o": {"x": ["y"]}, "t": {"q": ["z"]}}}, True),
        ({"detail": {"missing": {"x": [{"exists": False}]}}}, False),
        ({"detail": {"$or": [{"s": ["no"]}, {"o": {"x": ["y"]}}]}}, True),
        ({"$or": [{"source": ["no"]}, {"detail": {"s": ["abc"]}}]}, True),
        ({"$or": [{"source": ["no"]}]}, False),
        ({"resources": [{"prefix": "arn:b"}]}, True),
        ({"resources": ["arn:c"]}, False),
        ({"time": ["never looked at"]}, True),
    ],
)
def test_bus_patterns(spark, pattern, want):
    assert (pt.match_event(bus(spark, DETAIL), pattern).count() == 1) is want


def test_detail_that_is_no_json_matches_no_detail_pattern(spark):
    for text in ("{oops", None):
        assert pt.match_event(bus(spark, text), {"detail": {"x": [None]}}).count() == 0
        assert pt.match_event(bus(spark, text), {"source": ["my.app"]}).count() == 1


def test_plain_columns_are_tested_in_the_scan(spark, tmp_path):
    bus(spark, DETAIL).write.parquet(str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e"))
    kept = pt.match_event(events, {"source": ["my.app"], "detail": {"s": ["abc"]}})
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(source,my.app)" in plan and kept.count() == 1


def test_rules_fan_out_to_targets_of_enabled_rules(spark, rows):
    rules = [
        {"name": "a", "bus": "default", "pattern": None, "targets": ["t1", "t2"]},
        {"name": "b", "bus": "other", "pattern": None, "targets": ["t3"]},
        {"name": "c", "bus": "default", "pattern": {"detail": {"s": ["abc"]}}, "targets": ["t4"]},
        {"name": "d", "bus": "default", "pattern": None, "targets": ["t5"], "enabled": False},
    ]
    got = routing.match_rules(bus(spark, DETAIL), rules)
    assert rows(got, "rule", "target") == [("a", "t1"), ("a", "t2"), ("c", "t4")]


def test_many_rules_take_several_passes(spark):
    rules = [{"name": f"r{i}", "bus": "default", "pattern": {"detail": {"n": [str(i)]}}, "targets": ["t"]} for i in range(450)]
    got = routing.match_rules(bus(spark, DETAIL), rules).collect()
    assert [r.rule for r in got] == ["r5"]


# ── messages ─────────────────────────────────────────────────────────────────────


@pytest.mark.parametrize(
    ("policy", "want"),
    [
        (None, True),
        ({"color": ["red"]}, True),
        ({"color": ["blue"]}, False),
        ({"color": [{"prefix": "r"}], "n": [{"numeric": [">=", 100, "<", 200]}]}, True),
        ({"n": [100]}, True),
        ({"color": [{"anything-but": ["red"]}]}, False),
        ({"missing": [{"anything-but": ["red"]}]}, False),
        ({"missing": [{"exists": False}]}, True),
        ({"color": [{"exists": True}]}, True),
        ({"color": "red"}, False),
        ("[1]", False),
        ("{bad", False),
        ({"color": [{"numeric": [">", 1]}]}, False),
    ],
)
def test_attribute_policies(spark, policy, want):
    df = spark.createDataFrame([({"color": "red", "n": "100.0"},)], "attributes map<string,string>")
    assert (pt.match_attributes(df, policy).count() == 1) is want


BODY = {"s": "abc", "n": 5, "b": True, "nil": None, "a": ["x", 3], "empty": [], "blank": "", "bare": {}, "zero": 0, "o": {"k": "v", "a": [{"q": 1}]}}


@pytest.mark.parametrize(
    ("policy", "want"),
    [
        ({"s": ["abc"]}, True),
        ({"s": [{"prefix": "ab"}]}, True),
        ({"n": [5.0]}, True),
        ({"n": ["5"]}, False),
        ({"b": [True]}, True),
        ({"b": [False]}, False),
        ({"nil": [None]}, True),
        ({"missing": [None]}, False),
        ({"a": ["x"]}, True),
        ({"a": [{"numeric": ["=", 3]}]}, True),
        ({"a": [{"anything-but": ["x"]}]}, True),
        ({"a": [{"exists": True}]}, True),
        ({"empty": [{"exists": True}]}, False),
        ({"empty": [{"exists": False}]}, True),
        ({"blank": [{"exists": True}]}, False),
        ({"bare": [{"exists": False}]}, True),
        ({"zero": [{"exists": True}], "b": [{"exists": True}], "o": [{"exists": True}]}, True),
        ({"missing": [{"exists": False}]}, True),
        ({"missing": [{"anything-but": ["x"]}]}, False),
        ({"s": [{"anything-but": "abc"}]}, False),
        ({"o": {"k": ["v"]}}, True),
        ({"o": {"k": ["w"]}}, False),
        ({"s": "abc"}, False),
    ],
)
def test_body_policies(spark, policy, want):
    assert one(spark, json.dumps(BODY), lambda df: pt.match_body(df, policy, "j")) is want


def test_invalid_body_is_delivered_only_without_policy(spark):
    assert not one(spark, "nope{", lambda df: pt.match_body(df, {"s": [{"exists": False}]}, "j"))
    assert one(spark, "nope{", lambda df: pt.match_body(df, None, "j"))


def test_topic_filters(spark, rows):
    df = spark.createDataFrame([("a",), ("a/b",), ("a/b/c",), ("x.b/c",), ("a/",)], "topic string")
    rules = [
        {"name": f, "filter": f} for f in ("a/#", "a/+", "+/b", "a/b/c", "#", "a/#/c", "x+b/c", "+")
    ]
    got = {}
    for r in routing.match_topic(df, rules).collect():
        got.setdefault(r.rule, set()).add(r.topic)
    assert got == {
        "a/#": {"a", "a/b", "a/b/c", "a/"},
        "a/+": {"a/b", "a/"},
        "+/b": {"a/b"},
        "a/b/c": {"a/b/c"},
        "#": {"a", "a/b", "a/b/c", "x.b/c", "a/"},
        "+": {"a"},
    }


def test_choices(spark):
    rules = [
        {"Variable": "$.a.b", "StringEquals": "x", "Next": "first"},
        {"And": [{"Variable": "$.n", "NumericGreaterThanEquals": 5}, {"Not": {"Variable": "$.n", "NumericGreaterThan": 7}}], "Next": "five"},
        {"Variable": "$.g", "StringMatches": "log-*.txt", "Next": "glob"},
        {"Variable": "$.f", "BooleanEquals": True, "Next": "flag"},
        {"Variable": "$.z", "IsNull": False, "Next": "filled"},
        {"And": [{"Variable": "$.z", "IsPresent": True}, {"Variable": "$.z", "IsNull": True}], "Next": "null"},
        {"Variable": "$.k", "NumericLessThanPath": "$.m", "Next": "less"},
    ]
    cases = {
        '{"a":{"b":"x"},"n":6}': "first",
        '{"n":5}': "five",
        '{"n":8,"g":"log-1.txt"}': "glob",
        '{"n":8,"g":"log-1Xtxt","f":true}': "flag",
        '{"z":1}': "filled",
        '{"z":null}': "null",
        '{"k":1,"m":2}': "less",
        '{"k":2,"m":1}': "other",
        "{}": "other",
    }
    df = spark.createDataFrame([(k,) for k in cases], "input string")
    assert {r.input: r.next for r in routing.route(df, rules, "other").collect()} == cases


def test_templates(spark):
    df = spark.createDataFrame([(json.dumps({"a": "q", "n": 1, "in": json.dumps({"x": [{"y": "deep"}]}), "o": {"k": 1}}),)], "body string")
    got = reshape.render(df, "<$.a>|<$.n>|<$.in.x[0].y>|<$.o>|<$.gone>|").first().rendered
    assert got == '"q"|1|"deep"|{"k":1}||'
    got = reshape.render(df, "<a> <n> <zz>", paths={"a": "$.a", "n": "$.n"}).first().rendered
    assert got == "q 1 <zz>"


def test_projection_keeps_nesting_and_drops_what_is_missing(spark):
    df = spark.createDataFrame([('{"a":{"b":1,"c":2},"l":[{"x":1,"y":2},5],"n":null}',)], "item string")
    got = reshape.project_paths(df, ["a.b", "l[0].x", "n", "q.r", "a.zz"]).first().projected
    assert json.loads(got) == {"a": {"b": 1}, "l": [{"x": 1}], "n": None}


def test_archive_and_replay(spark, tmp_path):
    events = bus(spark, DETAIL).select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("id"))
    events = events.withColumn("event_time", F.timestamp_seconds(F.col("id") * 86400))
    path = str(tmp_path / "arch")
    stored = routing.archive(events, {"source": ["my.app"]}, path)
    stored = routing.archive(events.where("id = 0"), {"source": ["other"]}, path)
    assert stored.count() == 5
    again = routing.replay(stored, "1970-01-02 00:00:00", "1970-01-03 00:00:00").collect()
    assert [r.id for r in again] == [1, 2]


def test_shards_are_stable(spark):
    got = spark.range(1000).select(routing.shard_of(F.col("id").cast("string"), 4).alias("s")).groupBy("s").count().collect()
    assert {r.s for r in got} == {0, 1, 2, 3} and all(r["count"] > 150 for r in got)


def test_split_and_receive_limit(spark, rows):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    good, bad = routing.split_bad(df, F.col("v").try_cast("int"))
    assert rows(good) == [("1", 1)] and rows(bad) == [("x",)]
    log = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "message_id string")
    assert rows(routing.over_received(log, 2)) == [("a", 3)]


def test_user_functions_enrich_and_drop_empty_batches(spark, rows):
    df = spark.range(4).repartition(2)
    doubled = routing.enrich_with(df, lambda pdf: pdf.assign(twice=pdf["id"] * 2), "id long, twice long")
    assert rows(doubled) == [(0, 0), (1, 2), (2, 4), (3, 6)]
    assert routing.enrich_with(df, lambda pdf: None, "id long").count() == 0


def test_functions_are_found_by_pattern(spark):
    from lumenloom.functions.user import list_functions, register_functions

    assert register_functions(spark) == ["item_size"]
    assert spark.sql("""SELECT item_size('{"a":{"S":"bc"}}') AS n""").first().n == 3
    assert [r.function for r in list_functions(spark, "item_*").collect()] == ["item_size"]


def test_numbers_of_any_size(spark):
    from lumenloom.operators import patterns

    cases = ['{"k": 1e30}', '{"k": 123456789012345678901234567890}', '{"k": 0.1234567890123}', '{"k": -5}', '{"k": "7"}']
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, record string")
    found = lambda test: [r.i for r in patterns.match_record(df, [{"k": [test]}]).orderBy("i").collect()]
    assert found({"numeric": [">", 0]}) == [0, 1, 2]
    assert found({"numeric": [">", 10**30]}) == []
    assert found({"numeric": [">=", 10**30]}) == [0]
    assert found(0.1234567890124) == []
    assert found(0.1234567890123) == [2]
    assert found(123456789012345678901234567890) == [1]


def test_no_live_rule_keeps_the_label_columns(spark):
    from lumenloom.operators import routing

    events = spark.createDataFrame([("b", "t", "{}", {"a": "1"})], "bus string, topic string, detail string, attributes map<string,string>")
    assert routing.match_rules(events, []).select("rule", "target").count() == 0
    assert routing.fan_out(events.withColumnRenamed("detail", "body"), []).select("subscription").count() == 0


def test_many_rules_in_one_scan(spark):
    from lumenloom.operators import routing

    events = spark.createDataFrame([("b", '{"k": "v7"}'), ("b", '{"k": "v399"}')], "bus string, detail string")
    rules = [{"name": f"r{i}", "bus": "b", "pattern": {"detail": {"k": [f"v{i}"]}}, "targets": ["x"]} for i in range(400)]
    assert sorted(r.rule for r in routing.match_rules(events, rules).collect()) == ["r399", "r7"]
