from __future__ import annotations

import base64
import json
import random
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumenloom.functions import collections as fc
from lumenloom.functions import numbers
from lumenloom.functions.item_sizes import item_sizes
from lumenloom.operators import documents as doc

ITEM = {
    "name": {"S": "Ada"},
    "age": {"N": "30"},
    "big": {"N": "123456789012345678901234567890.5"},
    "small": {"N": "-123456789012345678901234567890.25"},
    "tiny": {"N": "1E-20"},
    "ok": {"BOOL": True},
    "nil": {"NULL": True},
    "tags": {"SS": ["b", "a"]},
    "nums": {"NS": ["1.0", "2"]},
    "list": {"L": [{"S": "x"}, {"N": "7"}, {"M": {"k": {"S": "v"}}}]},
    "map": {"M": {"in": {"M": {"n": {"N": "5"}}}}},
    "same": {"S": "Ada"},
}


@pytest.mark.parametrize(
    ("test", "want"),
    [
        (lambda a: a("age").eq(30.0), True),
        (lambda a: a("age").eq("30"), False),
        (lambda a: a("age").ne("30"), True),
        (lambda a: a("gone").ne(1), True),
        (lambda a: a("gone").eq(1), False),
        (lambda a: a("gone").gt(1), False),
        (lambda a: ~a("gone").gt(1), True),
        (lambda a: a("age").gt(5), True),  # by value, not text
        (lambda a: a("age").between(30, 31), True),
        (lambda a: a("big").gt("a") | a("big").gt(123456789012345678901234567890), True),
        (lambda a: a("big").eq("123456789012345678901234567890.5"), False),
        (lambda a: a("small").lt(-123456789012345678901234567890), True),
        (lambda a: a("small").lt(a("big")) & a("big").eq(a("big")), True),
        (lambda a: a("tiny").gt(0), True),
        (lambda a: a("tiny").eq(0), False),
        (lambda a: a("name").lt("Adb"), True),
        (lambda a: a("name").in_(["x", "Ada"]), True),
        (lambda a: a("name").begins_with("Ad"), True),
        (lambda a: a("name").contains("d"), True),
        (lambda a: a("name").eq(a("same")), True),
        (lambda a: a("ok").eq(True), True),
        (lambda a: a("ok").eq(False), False),
        (lambda a: a("nil").eq(None), True),
        (lambda a: a("nil").exists(), True),
        (lambda a: a("gone").not_exists(), True),
        (lambda a: a("tags").eq({"a", "b"}), True),
        (lambda a: a("tags").eq({"a"}), False),
        (lambda a: a("tags").contains("a"), True),
        (lambda a: a("tags").contains("ab"), False),
        (lambda a: a("nums").contains(1), True),
        (lambda a: a("nums").eq({1, 2}), True),
        (lambda a: a("list").contains("x"), True),
        (lambda a: a("list").contains(7), True),
        (lambda a: a("list[1]").eq(7), True),
        (lambda a: a("list[2].k").eq("v"), True),
        (lambda a: a("list[9]").exists(), False),
        (lambda a: a("map.in.n").ge(5), True),
        (lambda a: a("age").is_type("N") & ~a("age").is_type("S"), True),
        (lambda a: a("name").size() == 3, True),
        (lambda a: a("list").size() == 3, True),
        (lambda a: a("map").size() == 1, True),
        (lambda a: a("tags").size() > 2, False),
        (lambda a: a("age").size() == 2, True),
        (lambda a: a("list[2]").eq({"k": "v"}), True),
    ],
)
def test_item_predicates(spark, test, want):
    df = spark.createDataFrame([(json.dumps(ITEM),)], "item string")
    assert (doc.doc_where(df, test).count() == 1) is want
    as_variant = df.select(F.parse_json("item").alias("item"))
    assert (doc.doc_where(as_variant, test).count() == 1) is want


@pytest.mark.parametrize(
    ("conditions", "want"),
    [
        ({"age": ("EQ", [30]), "name": ("BEGINS_WITH", ["A"])}, True),
        ({"age": ("EQ", ["30.0"])}, False),
        ({"age": ("EQ", [30.0])}, True),
        ({"age": ("IN", [Decimal("30.00")])}, True),
        ({"nums": ("CONTAINS", [2])}, True),
        ({"nums": ("CONTAINS", [1])}, False),
        ({"list": ("CONTAINS", ["x"])}, False),
        ({"nums": ("NOT_CONTAINS", [2])}, True),
        ({"map": ("LT", ["z"])}, False),
        ({"gone": ("NE", [1])}, True),
        ({"gone": ("NULL", [])}, True),
        ({"name": ("NOT_NULL", [])}, True),
        ({"age": ("IN", [1, 30])}, True),
        ({"tags": ("CONTAINS", ["a"]), "name": ("NOT_CONTAINS", ["z"])}, True),
        ({"gone": ("NOT_CONTAINS", ["z"])}, True),
        ({"age": ("BETWEEN", [29, 31]), "name": ("GT", ["A"])}, True),
        ({"age": ("LE", [29])}, False),
    ],
)
def test_legacy_conditions(spark, conditions, want):
    df = spark.createDataFrame([(json.dumps(ITEM),)], "item string")
    assert (doc.doc_where_legacy(df, conditions).count() == 1) is want


def plain_size(value):
    ((kind, body),) = value.items()
    binary = lambda x: len(base64.b64decode(x))
    if kind in ("S", "N"):
        return len(body.encode())
    if kind == "B":
        return binary(body)
    if kind in ("SS", "NS", "BS"):
        return sum((binary(v) if kind == "BS" else len(v.encode())) + 1 for v in body)
    if kind == "L":
        return sum(plain_size(v) + 3 for v in body)
    if kind == "M":
        return sum(len(k.encode()) + 4 + plain_size(v) for k, v in body.items())
    return 1


def test_item_sizes_of_any_shape():
    """Random nesting, escapes, surrogates and white space, against parsed objects; also of slices and nulls."""
    r = random.Random(17)
    text = lambda: "".join(r.choices(["a", "é", "😀", '"', "\\", "\n", "{", "}", "[", ":", ",", "=", " ", "的", "/", "\u0001"], k=r.randrange(7)))
    coded = lambda: base64.b64encode(r.randbytes(r.randrange(8))).decode()

    def value(deep):
        kinds = ["S", "N", "B", "BOOL", "NULL", "SS", "NS", "BS"] + ["L", "M"] * (2 if deep < 4 else 0)
        kind = r.choice(kinds)
        some = range(r.randrange(4))
        made = {
            "S": text, "N": lambda: str(r.randrange(10**6)), "B": coded, "BOOL": lambda: r.random() < 0.5, "NULL": lambda: True,
            "SS": lambda: [text() for _ in some], "NS": lambda: [str(r.random()) for _ in some], "BS": lambda: [coded() for _ in some],
            "L": lambda: [value(deep + 1) for _ in some], "M": lambda: {text(): value(deep + 1) for _ in some},
        }
        return {kind: made[kind]()}

    items = [{text() or "k": value(0) for _ in range(r.randrange(5))} for _ in range(600)]
    texts = [json.dumps(x, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1]), separators=r.choice([None, (",", ":"), (" , ", " : ")])) for x in items]
    want = [sum(len(k.encode()) + plain_size(v) for k, v in x.items()) for x in items]
    column = pa.array([t if i % 50 else None for i, t in enumerate(texts)])
    got = item_sizes(column).to_pylist()
    assert got == [w if i % 50 else None for i, w in enumerate(want)]
    assert item_sizes(column.slice(33, 70)).to_pylist() == got[33:103]
    assert item_sizes(pa.array([], pa.string())).to_pylist() == []
    assert item_sizes(pa.array([None, "{}", " { } "])).to_pylist() == [None, 0, 0]


def test_item_size(spark):
    item = {
        "é": {"S": "ü"},  # 2 + 2
        "n": {"N": "12.5"},  # 1 + 4
        "b": {"B": "AAEC"},  # 1 + 3
        "t": {"BOOL": False},  # 1 + 1
        "z": {"NULL": True},  # 1 + 1
        "s": {"SS": ["a", "bc"]},  # 1 + 2 + 3
        "l": {"L": [{"S": "x"}, {"L": []}]},  # 1 + (1 + 3) + (0 + 3)
        "m": {"M": {"k": {"N": "1"}}},  # 1 + 1 + 1 + 1 + 3
    }
    df = spark.createDataFrame([(json.dumps(item),), (None,)], "item string")
    assert [r.s for r in df.select(doc.item_size("item").alias("s")).collect()] == [4 + 5 + 4 + 2 + 2 + 6 + 8 + 7, None]


def test_expiry_is_strict_and_needs_a_whole_number(spark, rows):
    df = spark.createDataFrame([("a", "99"), ("b", "100"), ("c", "x"), ("d", None)], "k string, t string")
    assert rows(doc.drop_expired(df, "t", 100), "k") == [("b",), ("c",), ("d",)]


def test_key_query_limits_before_it_filters(spark):
    data = [("p", i, "keep" if i % 2 else "drop", str(i)) for i in range(6)] + [("q", 9, "keep", "9"), ("p", None, "keep", "9")]
    df = spark.createDataFrame(data, "pk string, sk int, v string, ttl string")

    def run(**kw):
        return [r.sk for r in doc.key_query(df, ("pk", "p"), "sk", **kw).collect()]

    assert run(index=True) == [0, 1, 2, 3, 4, 5]
    assert run(forward=False, index=True, limit=2) == [5, 4]
    assert run(limit=3, filter_test=F.col("v") == "keep", index=True) == [1]
    assert run(sort_test=F.col("sk") >= 4) == [4, 5]
    # expired rows do not count towards the limit
    assert run(index=True, limit=2, expires=("ttl", 3)) == [3, 4]


def test_pages_count_rows_read(spark):
    df = spark.createDataFrame([(i // 3, i, i % 2) for i in range(7)], "a int, b int, v int")
    keys = ["a", "b"]
    first = doc.page(df, keys, 4, predicate=F.col("v") == 1).collect()
    assert [r.b for r in first] == [1, 3]
    cursor = tuple(doc.page_cursor(df, keys, 4).first())
    assert cursor == (1, 3)
    assert [r.b for r in doc.page(df, keys, 4, cursor).collect()] == [4, 5, 6]
    assert tuple(doc.page_cursor(df, keys, 4, cursor).first()) == (None, None)
    assert tuple(doc.page_cursor(df, keys, 7).first()) == (None, None)


def test_page_by_size(spark, rows):
    data = [("k", i, s) for i, s in enumerate([5, 4, 2, 1])] + [("big", 0, 50), ("big", 1, 1)]
    df = spark.createDataFrame(data, "k string, i int, size long")
    for tasks in (1, 2, 7):
        got = rows(doc.page_by_size(df, ["k"], ["i"], F.col("size"), 10, tasks), "k", "i")
        assert got == [("big", 0), ("k", 0), ("k", 1)]


def test_sets_and_lists(spark):
    row = spark.range(1).select(
        fc.set_add(F.array(F.lit("b")), F.array(F.lit("a"), F.lit("b"))).alias("added"),
        fc.set_add(F.lit(None).cast("array<string>"), F.array(F.lit("a"))).alias("new"),
        fc.set_remove(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a"))).alias("left"),
        fc.set_remove(F.array(F.lit("a")), F.array(F.lit("a"))).alias("gone"),
        fc.list_append(F.array(F.lit("a")), F.array(F.lit("a"))).alias("both"),
    ).first()
    assert row.asDict() == {"added": ["b", "a"], "new": ["a"], "left": ["b"], "gone": None, "both": ["a", "a"]}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("007.500", "7.5"),
        ("-0.0", "0"),
        ("1e3", "1000"),
        ("-1.5E-3", "-0.0015"),
        ("100", "100"),
        (".5", "0.5"),
        ("+5.", "5"),
        ("9" * 38, "9" * 38),
        ("9" * 39, None),
        ("1" + "0" * 60, "1" + "0" * 60),
        ("abc", None),
        (None, None),
    ],
)
def test_number_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(numbers.normalize_number(F.col("t")).alias("n")).first().n == want


def test_decimal_text_arithmetic(spark):
    row = spark.range(1).select(
        numbers.decimal_add(F.lit("0.1"), F.lit("0.2")).alias("a"),
        numbers.decimal_subtract(F.lit("1"), F.lit("1.0")).alias("b"),
        numbers.decimal_add(F.lit("x"), F.lit("1")).alias("c"),
    ).first()
    assert tuple(row) == ("0.3", "0", None)


def test_arrays_and_sums_in_json(spark):
    data = [
        ('[{"a":1,"b":[2]},"x",null]', '{"b":[2],"a":1}', 3, True), ("[1,2]", "1.5", 2, False), ("[1]", '"1"', 1, False), ('["é"]', '"é"', 1, True),
        ("[null]", "null", 1, True), ("[]", "1", 0, False), ('{"a":1}', "1", None, None), ('"text"', '"t"', None, None), (None, "1", None, None),
    ]
    df = spark.createDataFrame(data, "v string, w string, n int, held boolean").select(F.parse_json("v").alias("v"), F.parse_json("w").alias("w"), "n", "held")
    for r in df.select("n", "held", fc.array_length(F.col("v")).alias("got_n"), fc.array_contains(F.col("v"), F.col("w")).alias("got_held")).collect():
        assert (r.got_n, r.got_held) == (r.n, r.held)
    sums = [("1", "2", 3), ("1.9", "-1.9", 0), ('"5"', "1", 6), ('"x"', "4", 4), ("null", "4", 4), ("true", "1e3", 1001)]
    df = spark.createDataFrame(sums, "a string, b string, want long")
    for r in df.select("a", "want", fc.add_whole(F.parse_json("a"), F.parse_json("b")).alias("got")).collect():
        assert r.got == r.want, r
    row = spark.range(1).select(F.to_json(fc.array_of(F.parse_json(F.lit('{"k":[1]}')), F.lit(None).cast("variant"))).alias("j")).first()
    assert row.j == '[{"k":[1]},null]'
    ids = [r.u for r in spark.range(50).select(F.uuid().alias("u")).collect()]
    assert len(set(ids)) == 50 and all(len(u) == 36 and u.count("-") == 4 for u in ids)
