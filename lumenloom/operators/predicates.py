"""Loosely typed predicates over text columns and partition values."""

from __future__ import annotations

import re
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenloom.functions.booleans import compare, every, known, leaf
from lumenloom.functions.numbers import NUMBER_TEXT, compare_to, text_to_double
from lumenloom.functions.text import like_pattern
from lumenloom.sources.files import resolve


def _number(text) -> float | None:
    return float(str(text)) if re.match(NUMBER_TEXT, str(text)) else None


def _literal(value) -> Column:
    """A number without a fraction as an integer, so that comparisons with one need no cast."""
    exact = Decimal(str(value))
    return F.lit(int(exact)) if exact == exact.to_integral_value() else F.lit(float(exact))


class LooseColumn:
    """A column compared as a number when both sides are numbers, else as text.

    Every test is two-valued: false on a missing value, so ``~test`` is true there.
    """

    def __init__(self, column: Column, numeric: bool):
        self.column = column
        self.text = column.cast("string")
        self.numeric = numeric

    def _compare(self, op: str, value) -> Column:
        number = _number(value)
        if number is None:
            return known(compare(self.text, op, F.lit(str(value))), self.text)
        if self.numeric:
            # a plain comparison, which the optimiser can push into the scan
            return known(compare(self.column, op, _literal(value)), self.column)
        as_number = text_to_double(self.text)
        return leaf(
            F.when(as_number.isNotNull(), compare(as_number, op, F.lit(number))).otherwise(
                compare(self.text, op, F.lit(str(value)))
            )
        )

    def eq(self, value) -> Column:
        return self._compare("=", value)

    def ne(self, value) -> Column:
        return self._compare("<>", value)

    def gt(self, value) -> Column:
        return self._compare(">", value)

    def ge(self, value) -> Column:
        return self._compare(">=", value)

    def lt(self, value) -> Column:
        return self._compare("<", value)

    def le(self, value) -> Column:
        return self._compare("<=", value)

    def between(self, low, high) -> Column:
        return self.ge(low) & self.le(high)

    def in_(self, values) -> Column:
        """Text equality only: 30 is not 30.0 here, although = says it is."""
        return known(self.text.isin([str(v) for v in values]), self.text)

    def like(self, pattern: str) -> Column:
        return known(like_pattern(self.text, pattern), self.text)

    def is_null(self) -> Column:
        return self.column.isNull()

    def is_not_null(self) -> Column:
        return self.column.isNotNull()


def loose(df: DataFrame) -> Callable[[str], LooseColumn]:
    """A lookup of columns by name in any case or by position _N."""

    def find(name: str) -> LooseColumn:
        column = resolve(df, name)
        kind = df.select(column.alias("c")).schema["c"].dataType
        return LooseColumn(column, isinstance(kind, T.NumericType))

    return find


def where_loose(df: DataFrame, predicate: Callable) -> DataFrame:
    """``where_loose(df, lambda c: c("age").gt(30) & ~c("city").like("N%"))``"""
    return df.where(predicate(loose(df)))


class PartitionColumn(LooseColumn):
    """As LooseColumn with exact decimals: '01' equals 1, but in_() compares text."""

    def _compare(self, op: str, value) -> Column:
        if _number(value) is None:
            return known(compare(self.text, op, F.lit(str(value))), self.text)
        if self.numeric:
            return known(compare(self.column, op, _literal(value)), self.column)
        by_value = compare_to(F.trim(self.text), op, str(value).strip())
        return leaf(F.coalesce(by_value, compare(self.text, op, F.lit(str(value)))))


def prune_partitions(df: DataFrame, keys: list[str], predicate: Callable | None = None) -> DataFrame:
    """Partitions whose values satisfy the predicate, ordered by their values as text.

    ``df`` is a listing of partitions (one row each) or a partitioned table. A key
    that is no partition key matches nothing.
    """
    numeric = {f.name: isinstance(f.dataType, T.NumericType) for f in df.schema.fields}

    def find(name: str) -> PartitionColumn:
        if name in keys:
            return PartitionColumn(F.col(f"`{name}`"), numeric[name])
        return PartitionColumn(F.lit(None).cast("string"), False)

    chosen = df.where(predicate(find)) if predicate else df
    return chosen.orderBy(*[F.col(f"`{k}`").cast("string").asc_nulls_first() for k in keys])


def match_attributes_exact(df: DataFrame, wanted: dict[str, str], attributes: str = "attributes") -> DataFrame:
    """Rows whose attribute map holds every wanted value as exact text."""
    tests = [
        leaf(F.try_element_at(F.col(attributes), F.lit(k)) == v) for k, v in wanted.items()
    ]
    return df.where(every(tests))


def attribute_values(df: DataFrame, name: str, attributes: str = "attributes") -> DataFrame:
    """Distinct values one attribute takes, in text order."""
    values = df.select(F.try_element_at(F.col(attributes), F.lit(name)).alias("value"))
    return values.where("value IS NOT NULL").distinct().orderBy("value")


def where_attr(df: DataFrame, attr: str, op: str, value: str, attributes: str = "attributes") -> DataFrame:
    """``attr = value`` or ``attr ^= value`` (prefix) on a column or, else, the attribute map."""
    aliases = {"cognito:user_status": "status"}  # fixed value: long name of the status column
    column = aliases.get(attr, attr)
    actual = F.col(column) if column in df.columns else F.try_element_at(F.col(attributes), F.lit(attr))
    if op == "=":
        return df.where(actual == value)
    if op == "^=":
        return df.where(actual.startswith(value))
    raise ValueError(f"unknown operator {op!r}")


def find_by_tags(
    df: DataFrame,
    tags: dict[str, list[str]] | None = None,
    types: list[str] | None = None,
    region: str | None = None,
    names: list[str] | None = None,
    after: str | None = None,
    page_size: int | None = None,
    name: str = "resource",
    tag_map: str = "tags",
) -> DataFrame:
    """Resources by tag (AND over keys, OR over values, none = any), type and region.

    Resource names read ``arn:partition:service:region:account:type/id``; a type
    filter is ``service`` or ``service:type`` in any case. Ordered by name; a page
    starts strictly after the name ``after``.
    """
    parts = F.split(F.col(name), ":", 6)
    tests = []
    if region is not None:
        place = F.coalesce(F.get(parts, 3), F.lit(""))
        tests.append(place.isin("", region))
    if names:
        tests.append(F.col(name).isin(names))
    for key, values in (tags or {}).items():
        value = F.try_element_at(F.col(tag_map), F.lit(key))
        tests.append(leaf(value.isin(values)) if values else value.isNotNull())
    if types:
        service = F.lower(F.get(parts, 2))
        kind = F.lower(F.split_part(F.get(parts, 5), F.lit("/"), F.lit(1)))
        options = []
        for wanted in types:
            head, _, tail = wanted.lower().partition(":")
            options.append((service == head) & (kind == tail) if tail else service == head)
        test = options[0]
        for option in options[1:]:
            test = test | option
        tests.append(leaf(test))
    if after is not None:
        tests.append(F.col(name) > after)
    out = df.where(every(tests)).orderBy(name)
    return out.limit(page_size) if page_size else out
