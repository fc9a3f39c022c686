"""Two-valued logic (a test on a missing value is false, and NOT of it is true) and shared values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def leaf(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used.

    A lambda variable keeps the optimiser from copying the expression into each use.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def known(test: Column, column: Column) -> Column:
    """As ``leaf`` for a test of one column, in a form that still reaches the file scan."""
    return column.isNotNull() & test


def _joined(tests: list[Column], join, empty: bool) -> Column:
    """Joined as a balanced tree: hundreds of tests in a chain would be too deep to analyse."""
    if not tests:
        return F.lit(empty)
    while len(tests) > 1:
        pairs = zip(tests[::2], tests[1::2])
        odd = tests[-1:] if len(tests) % 2 else []
        tests = [join(a, b) for a, b in pairs] + odd
    return tests[0]


def every(tests) -> Column:
    return _joined(list(tests), lambda a, b: a & b, True)


def some(tests) -> Column:
    return _joined(list(tests), lambda a, b: a | b, False)


def compare(left: Column, op: str, right: Column) -> Column:
    """Apply a comparison given by its written operator."""
    if op in ("=", "=="):
        return left == right
    if op in ("<>", "!="):
        return left != right
    if op == "<":
        return left < right
    if op == "<=":
        return left <= right
    if op == ">":
        return left > right
    if op == ">=":
        return left >= right
    raise ValueError(f"unknown comparison {op!r}")
