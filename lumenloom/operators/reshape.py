"""Rebuilding nested values: projections, templates and array items."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenloom.functions import json_paths as jp
from lumenloom.functions.booleans import bound

_PLACEHOLDER = re.compile(r"<(\$\.?[^>]*)>")
_NAMED = re.compile(r"<([A-Za-z0-9_.-]+)>")


def project_paths(df: DataFrame, paths: list[str], json: str = "item") -> DataFrame:
    """Adds ``projected``: JSON with only the named paths, in their nesting.

    A list index keeps just that element, in a list. What is missing is left out.
    """
    tree: dict = {}
    for path in paths:
        node = tree
        for step in jp.segments(path):
            node = node.setdefault(step, {})

    def build(v: Column) -> Column:
        return F.to_json(_rebuild(v, tree))

    return df.withColumn("projected", bound(jp.parse(F.col(json)), build))


def _rebuild(v: Column, tree: dict) -> Column:
    fields = []
    for step, below in tree.items():
        child = jp.at(v, [step])
        indexes = [s for s in below if isinstance(s, int)]
        if not below:
            value = child
        elif indexes:
            kept = [jp.at(child, [i]) if not below[i] else _rebuild(jp.at(child, [i]), below[i]) for i in indexes]
            value = F.array_compact(F.array(*kept))
            value = F.when(F.size(value) > 0, value)
        else:
            value = F.when(child.isNotNull(), _rebuild(child, below))
        fields.append(value.alias(step))
    return F.struct(*fields)


def render(df: DataFrame, template: str, json: str = "body", paths: dict[str, str] | None = None) -> DataFrame:
    """Adds ``rendered``: the template with its placeholders filled from the JSON.

    ``<$.path>`` puts JSON text (strings quoted, text that holds JSON is entered);
    ``<name>``, with its path in ``paths``, puts bare text. Missing gives ''.
    """
    pattern = _PLACEHOLDER if paths is None else _NAMED

    def filled(v: Column) -> Column:
        pieces: list[Column] = []
        last = 0
        for hit in pattern.finditer(template):
            if paths is not None and hit.group(1) not in paths:
                continue
            pieces.append(F.lit(template[last : hit.start()]))
            if paths is None:
                value = bound(jp.walk_in(v, hit.group(1)), jp.quoted)
            else:
                value = jp.as_text(jp.at(v, jp.segments(paths[hit.group(1)])))
            pieces.append(F.coalesce(value, F.lit("")))
            last = hit.end()
        return F.concat(*pieces, F.lit(template[last:]))

    # parsed once for all placeholders
    parsed = jp.parse(F.col(json))
    return df.withColumn("rendered", bound(bound(parsed, jp.parse_inside) if paths is None else parsed, filled))


def map_items(df: DataFrame, items: str, selector, name: str = "mapped") -> DataFrame:
    """Adds an array with a new value per item: ``selector(item, index)`` (index from 0).

    The selector may also use literals and any other column of the row.
    """
    return df.withColumn(name, F.transform(F.col(items), lambda x, i: selector(x, i)))
