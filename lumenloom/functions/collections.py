"""Array and map helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenloom.functions import json_paths as jp
from lumenloom.functions.booleans import bound


def set_add(current: Column, extra: Column) -> Column:
    """Union that keeps the order of first appearance; a missing set takes the new one."""
    return F.array_union(F.coalesce(current, F.array()), F.coalesce(extra, F.array()))


def set_remove(current: Column, gone: Column) -> Column:
    """Difference; an emptied set becomes null, that is the attribute is removed."""
    left = F.array_except(current, F.coalesce(gone, F.array()))
    return F.when(F.size(left) > 0, left)


def list_append(first: Column, second: Column) -> Column:
    return F.concat(F.coalesce(first, F.array()), F.coalesce(second, F.array()))


def if_not_exists(current: Column, fallback: Column) -> Column:
    return F.coalesce(current, fallback)


def dimension_key(dimensions: Column) -> Column:
    """Canonical text of a string map: name=value pairs by name."""
    pairs = F.array_sort(F.map_entries(dimensions))
    return F.array_join(
        F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","
    )


def holds_all(dimensions: Column, wanted: dict[str, str]) -> Column:
    """The map contains every wanted pair."""
    test = F.lit(True)
    for name, value in sorted(wanted.items()):
        test = test & F.coalesce(F.try_element_at(dimensions, F.lit(name)) == value, F.lit(False))
    return test


# ── arrays and numbers inside open JSON (VARIANT) ────────────────────────────────


def array_of(*values: Column) -> Column:
    """An array of the given VARIANT values; a missing one is JSON null."""
    return F.to_variant_object(F.array(*[F.coalesce(v, F.parse_json(F.lit("null"))) for v in values]))


def array_length(v: Column) -> Column:
    """How many items an array has; null for what is no array."""
    items = F.try_variant_get(v, "$", "array<variant>")
    return F.when(items.isNotNull(), F.size(items))


def array_contains(v: Column, wanted: Column) -> Column:
    """Whether an item equals a value at all depths; null for what is no array.

    Members of objects are compared by name, whatever their order; a whole number is not a fraction.
    """
    items = F.try_variant_get(v, "$", "array<variant>")
    same = lambda text: F.exists(items, lambda i: F.coalesce(canonical(i) == text, F.lit(False)))
    return F.when(items.isNotNull(), bound(canonical(wanted), same))


def canonical(v: Column) -> Column:
    """Text that equal values share: members by name (as VARIANT keeps them), JSON null as null."""
    return F.coalesce(F.to_json(v), F.lit("null"))


def add_whole(left: Column, right: Column) -> Column:
    """The sum of two JSON numbers as whole ones: fractions are cut, text counts if it is a number, all else is 0."""

    def whole(v: Column) -> Column:
        return F.coalesce(
            F.try_variant_get(v, "$", "bigint"),
            F.try_variant_get(v, "$", "double").cast("bigint"),
            jp.as_text(v).try_cast("bigint"),
            F.lit(0),
        )

    return F.try_add(whole(left), whole(right))
