"""Queries over document items.

An item is a JSON text (or VARIANT) of typed attribute values, for example
``{"age": {"N": "30"}, "name": {"S": "Ada"}}`` with the types S, N, B, BOOL, NULL,
SS, NS, BS, L and M.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenloom.functions import json_paths as jp
from lumenloom.functions.booleans import bound, compare, every, leaf, some
from lumenloom.functions.item_sizes import item_sizes
from lumenloom.functions.numbers import EXACT_TEXT, PLAIN_TEXT, normalize_number, order_text
from lumenloom.functions.text import text_units
from lumenloom.operators.ordered import running_total

PAGE_BYTES = 1024 * 1024  # fixed value: bytes of items one page may hold


def typed_steps(path: str) -> list[str | int]:
    """'a.b[0]' -> ['a', 'M', 'b', 'L', 0]"""
    out: list[str | int] = []
    for i, step in enumerate(jp.segments(path)):
        if i:
            out.append("L" if isinstance(step, int) else "M")
        out.append(step)
    return out


def typed(value) -> dict:
    """A Python value as a typed attribute value."""
    if isinstance(value, bool):
        return {"BOOL": value}
    if value is None:
        return {"NULL": True}
    if isinstance(value, (int, float, Decimal)):
        return {"N": str(value)}
    if isinstance(value, str):
        return {"S": value}
    if isinstance(value, (set, frozenset)):
        numbers = all(isinstance(v, (int, float, Decimal)) for v in value)
        return {"NS" if numbers else "SS": [str(v) for v in sorted(value)]}
    if isinstance(value, (list, tuple)):
        return {"L": [typed(v) for v in value]}
    if isinstance(value, dict):
        return {"M": {k: typed(v) for k, v in value.items()}}
    raise TypeError(f"no attribute type for {value!r}")


def compare_numbers(left: Column, op: str, right: Column) -> Column:
    """Numbers given as text: by value where a decimal or their digits can tell, else as doubles."""

    def test(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        exact = a.rlike(EXACT_TEXT) & b.rlike(EXACT_TEXT)
        plain = a.rlike(PLAIN_TEXT) & b.rlike(PLAIN_TEXT)
        by_decimal = compare(a.try_cast("decimal(38,12)"), op, b.try_cast("decimal(38,12)"))
        by_digits = compare(order_text(a), op, order_text(b))
        by_double = compare(a.try_cast("double"), op, b.try_cast("double"))
        return F.when(exact, by_decimal).when(plain, by_digits).otherwise(by_double)

    return bound(F.struct(left.alias("a"), right.alias("b")), test)


class Attr:
    """One attribute value of an item; every test is two-valued."""

    def __init__(self, node: Column):
        self.node = node

    def _get(self, kind: str, as_type: str = "string") -> Column:
        return F.try_variant_get(self.node, f"$.{kind}", as_type)

    @property
    def scalar(self) -> Column:
        """Text of a scalar value, '' for a container, null if missing."""
        text = F.coalesce(*[self._get(k) for k in ("S", "N", "B", "BOOL")], F.lit(""))
        return F.when(self.node.isNotNull(), text)

    def exists(self) -> Column:
        return self.node.isNotNull()

    def not_exists(self) -> Column:
        return self.node.isNull()

    def is_type(self, kind: str) -> Column:
        return self._get(kind, "variant").isNotNull()

    def eq(self, value) -> Column:
        """Type-aware equality; numbers by value, sets in any order."""
        if isinstance(value, Attr):
            same_text = leaf(self._get("S") == value._get("S"))
            same_number = leaf(compare_numbers(self._get("N"), "=", value._get("N")))
            same_rest = leaf(F.to_json(self.node) == F.to_json(value.node))
            return same_text | same_number | same_rest
        ((kind, body),) = typed(value).items()
        if kind == "N":
            return leaf(compare_numbers(self._get("N"), "=", F.lit(body)))
        if kind in ("S", "BOOL", "NULL"):
            return leaf(self._get(kind) == F.lit(body if kind == "S" else str(body).lower()))
        if kind in ("SS", "NS"):
            mine, wanted = self._get(kind, "array<string>"), F.array(*[F.lit(v) for v in body])
            if kind == "NS":
                mine = F.transform(mine, lambda x: x.try_cast("decimal(38,12)"))
                wanted = F.transform(wanted, lambda x: x.try_cast("decimal(38,12)"))
            same_size = F.size(mine) == F.size(wanted)
            return leaf(same_size & (F.array_sort(mine) == F.array_sort(wanted)))
        canonical = F.to_json(F.parse_json(F.lit(json.dumps({kind: body}))))
        return leaf(F.to_json(self.node) == canonical)

    def ne(self, value) -> Column:
        """True also when the attribute is missing."""
        return ~self.eq(value)

    def _ordered(self, op: str, value) -> Column:
        if isinstance(value, Attr):
            both_numbers = self.is_type("N") & value.is_type("N")
            numeric = compare_numbers(self._get("N"), op, value._get("N"))
            return leaf(F.when(both_numbers, numeric).otherwise(compare(self.scalar, op, value.scalar)))
        ((kind, body),) = typed(value).items()
        text = F.lit(body if isinstance(body, str) else str(body).lower())
        by_text = compare(self.scalar, op, text)
        if kind == "N":
            by_number = compare_numbers(self._get("N"), op, F.lit(body))
            return leaf(F.when(self.is_type("N"), by_number).otherwise(by_text))
        return leaf(by_text)

    def lt(self, value) -> Column:
        return self._ordered("<", value)

    def le(self, value) -> Column:
        return self._ordered("<=", value)

    def gt(self, value) -> Column:
        return self._ordered(">", value)

    def ge(self, value) -> Column:
        return self._ordered(">=", value)

    def between(self, low, high) -> Column:
        return self.ge(low) & self.le(high)

    def in_(self, values) -> Column:
        return some(self.eq(v) for v in values)

    def begins_with(self, prefix: str) -> Column:
        return leaf(self.scalar.startswith(prefix))

    def contains(self, value) -> Column:
        """Part of a text, or member of a set or list."""
        in_list = leaf(
            F.exists(self._get("L", "array<variant>"), lambda x: Attr(x).eq(value))
        )
        if isinstance(value, str):
            in_text = leaf(self._get("S").contains(value))
            in_set = leaf(F.array_contains(self._get("SS", "array<string>"), value))
            return in_text | in_set | in_list
        if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
            numbers = self._get("NS", "array<string>")
            in_set = leaf(F.exists(numbers, lambda x: compare_numbers(x, "=", F.lit(str(value)))))
            return in_set | in_list
        return in_list

    def size(self) -> Column:
        """Characters of a text or number, entries of a set, list or map; null if missing."""
        arrays = [F.size(self._get(k, "array<variant>")) for k in ("L", "SS", "NS", "BS")]
        entries = F.size(F.map_keys(self._get("M", "map<string,variant>")))
        sized = [
            text_units(self._get("S")),
            F.length(self._get("B")),
            *[F.when(self.is_type(k), a) for k, a in zip(("L", "SS", "NS", "BS"), arrays)],
            F.when(self.is_type("M"), entries),
            F.length(self._get("N")),
        ]
        return F.when(self.node.isNotNull(), F.coalesce(*sized, F.lit(0)))


def doc_test(predicate: Callable, item: Column) -> Column:
    """``predicate(attr)`` with ``attr(path)`` bound to the parsed item."""
    return predicate(lambda path: Attr(jp.at(item, typed_steps(path))))


def doc_where(df: DataFrame, predicate: Callable, item: str = "item") -> DataFrame:
    """``doc_where(df, lambda a: a("age").ge(30) & a("tags").contains("x"))``"""
    if isinstance(df.schema[item].dataType, T.VariantType):
        return df.where(doc_test(predicate, F.col(item)))
    return df.where(jp.with_parsed(F.col(item), lambda v: doc_test(predicate, v)))


def legacy_test(attr: Attr, op: str, values: list) -> Column:
    """One condition in the older per-attribute form, which compares written values.

    A number is written in its shortest form first, so 1.0 is 1; but '1' is no number.
    """
    if op == "NULL":
        return attr.not_exists()
    if op == "NOT_NULL":
        return attr.exists()
    written = F.coalesce(normalize_number(attr._get("N")), attr.scalar)
    wanted = [_written(v) for v in values]
    if op == "IN":
        return leaf(written.isin(wanted))
    is_scalar = some(attr.is_type(k) for k in ("S", "N", "B", "BOOL"))
    first, text = values[0], isinstance(values[0], str)
    number = isinstance(first, (int, float, Decimal)) and not isinstance(first, bool)
    in_text = leaf(attr._get("S").contains(str(first)))
    in_set = leaf(F.array_contains(attr._get("SS", "array<string>"), str(first)))
    in_numbers = leaf(F.array_contains(attr._get("NS", "array<string>"), str(first)))
    tests = {
        "EQ": lambda: leaf(written == wanted[0]) & _same_side(attr, number),
        "NE": lambda: ~leaf(written == wanted[0]),
        "BEGINS_WITH": lambda: leaf(written.startswith(wanted[0])),
        "CONTAINS": lambda: in_text | in_set if text else in_numbers if number else F.lit(False),
        "NOT_CONTAINS": lambda: ~(in_text | in_set) if text else F.lit(True),
        "GT": lambda: is_scalar & attr.gt(first),
        "GE": lambda: is_scalar & attr.ge(first),
        "LT": lambda: is_scalar & attr.lt(first),
        "LE": lambda: is_scalar & attr.le(first),
        "BETWEEN": lambda: is_scalar & attr.between(values[0], values[1]),
    }
    if op not in tests:
        raise ValueError(f"unknown condition {op!r}")
    return tests[op]()


def _written(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float, Decimal)):
        plain = format(Decimal(str(value)).normalize(), "f")
        return "0" if plain == "-0" else plain
    return str(value)


def _same_side(attr: Attr, number: bool) -> Column:
    """A number on one side only is compared as it was written, which here needs its shortest form."""
    raw_is_short = leaf(attr._get("N") == normalize_number(attr._get("N")))
    return F.lit(True) if number else attr._get("N").isNull() | raw_is_short


def doc_where_legacy(df: DataFrame, conditions: dict[str, tuple[str, list]], item: str = "item") -> DataFrame:
    """All (operator, values) conditions hold, one per attribute."""

    def predicate(attr):
        return every(legacy_test(attr(name), op, values) for name, (op, values) in conditions.items())

    return doc_where(df, predicate, item)


def drop_expired(df: DataFrame, column: str, now: int | Column) -> DataFrame:
    """Drops rows whose epoch seconds lie before now; without a whole number they stay."""
    now = now if isinstance(now, Column) else F.lit(now)
    return df.where(~leaf(F.col(column).try_cast("bigint") < now))


def key_query(
    df: DataFrame,
    partition: tuple[str, object],
    sort_key: str | None = None,
    sort_test: Column | None = None,
    forward: bool = True,
    limit: int | None = None,
    filter_test: Column | None = None,
    index: bool = False,
    expires: tuple[str, int] | None = None,
) -> DataFrame:
    """Rows of one partition key in sort-key order, or in reverse.

    Expired rows go first, then the limit counts the rows read, and the filter is
    applied last. An ``index`` holds no rows with a null key. The key test is a
    plain comparison: it prunes partitions and reaches the file statistics.
    """
    column, value = partition
    out = df.where(F.col(column) == F.lit(value))
    if index and sort_key:
        out = out.where(F.col(sort_key).isNotNull())
    if sort_test is not None:
        out = out.where(leaf(sort_test))
    if expires:
        out = drop_expired(out, *expires)
    if sort_key:
        out = out.orderBy(F.col(sort_key).asc() if forward else F.col(sort_key).desc())
    if limit:
        out = out.limit(limit)
    return out.where(leaf(filter_test)) if filter_test is not None else out


def page(
    df: DataFrame,
    keys: list[str],
    n: int,
    after: tuple | None = None,
    predicate: Column | None = None,
) -> DataFrame:
    """The next n rows in key order, strictly after a key; the predicate sees only them."""
    rows = _after(df, keys, after).orderBy(*keys).limit(n)
    return rows.where(leaf(predicate)) if predicate is not None else rows


def page_cursor(df: DataFrame, keys: list[str], n: int, after: tuple | None = None) -> DataFrame:
    """One row: the key to continue after, null when no row follows the page."""
    read = _after(df, keys, after).select(*keys).orderBy(*keys).limit(n + 1)
    key = F.struct(*keys)
    # one row more than the page tells whether anything is left
    counted = read.agg(F.count("*").alias("n"), F.array_sort(F.collect_list(key)).alias("read"))
    more = F.when(F.col("n") > n, F.try_element_at("read", F.lit(n)))
    return counted.select(more.alias("cursor")).select("cursor.*")


def _after(df: DataFrame, keys: list[str], after: tuple | None) -> DataFrame:
    if after is None:
        return df
    # lexicographic order spelled out, so the leading key stays a pushable range
    tests = []
    for i, (k, v) in enumerate(zip(keys, after)):
        same = [F.col(p) == F.lit(q) for p, q in zip(keys[:i], after[:i])]
        tests.append(every([*same, F.col(k) > F.lit(v)]) if same else F.col(k) > F.lit(v))
    leading = F.col(keys[0]) >= F.lit(after[0])
    return df.where(leading & some(tests))


def lookup(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows whose key is wanted; absent keys give none, repeated ones no extra rows.

    Without a hint: the optimiser broadcasts the keys while they are small.
    """
    return df.join(keys, on, "left_semi")


def page_by_size(
    df: DataFrame, keys: list[str], order: list[str], size: Column, most: int = PAGE_BYTES, tasks: int | None = None
) -> DataFrame:
    """Per key, the leading rows whose sizes add up to at most ``most``; the first always."""
    total = running_total(df, keys, order, size, "running_size", tasks)
    within = F.col("running_size") <= most
    first = F.col("running_size") == size
    return total.where(within | first)


# ── item size ────────────────────────────────────────────────────────────────────


@F.arrow_udf(T.LongType())
def item_size(items: pa.Array) -> pa.Array:
    """Bytes of an item: UTF-8 names and values, at any depth of nesting."""
    return item_sizes(items)
