"""String helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_upper(c: Column) -> Column:
    return F.upper(F.trim(c))


def like_pattern(c: Column, pattern: str) -> Column:
    """LIKE with % and _ only: a backslash in the pattern is an ordinary character."""
    return c.like(pattern.replace("\\", "\\\\"))


def glob_regex(pattern: str) -> str:
    return "^" + ".*".join(re.escape(part) for part in pattern.split("*")) + "$"


def glob_match(c: Column, pattern: str) -> Column:
    return c.rlike(glob_regex(pattern))


def topic_regex(topic_filter: str) -> str | None:
    """Anchored regex of a slash topic filter: + is one level, a last # the rest.

    None for a filter that can match nothing (# before the end).
    """
    parts = topic_filter.split("/")
    if "#" in parts[:-1]:
        return None
    body = "/".join("[^/]*" if p == "+" else re.escape(p) for p in parts if p != "#")
    if parts[-1] != "#":
        return f"^{body}$"
    # the rest may be empty, so the levels before # match on their own too
    return f"^{body}(/.*)?$" if len(parts) > 1 else "^.*$"


def text_units(c: Column) -> Column:
    """Length in UTF-16 code units; Spark's length() counts code points."""
    beyond_basic_plane = F.regexp_replace(c, r"[^\x{10000}-\x{10FFFF}]", "")
    return F.length(c) + F.length(beyond_basic_plane)


def csv_field(c: Column) -> Column:
    text = F.coalesce(c.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[,"\n]'), quoted).otherwise(text)


def csv_line(columns) -> Column:
    return F.concat_ws(",", *[csv_field(c) for c in columns])


def json_line(columns) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def fill_slots(template: str, *values: Column) -> Column:
    """Fill {} slots from left to right."""
    parts = template.split("{}")
    if len(parts) - 1 != len(values):
        raise ValueError(f"{len(parts) - 1} slots, {len(values)} values")
    pieces = [F.lit(parts[0])]
    for value, tail in zip(values, parts[1:]):
        pieces += [F.coalesce(value.cast("string"), F.lit("null")), F.lit(tail)]
    return F.concat(*pieces)
