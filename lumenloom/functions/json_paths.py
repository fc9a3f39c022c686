"""Access to open JSON through VARIANT."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenloom.functions.booleans import bound, leaf

_STEP = re.compile(r"\[(\d+)\]")


def segments(path: str) -> list[str | int]:
    """'a.b[0].c' -> ['a', 'b', 0, 'c']; a leading $ or $. is dropped."""
    path = path.removeprefix("$").removeprefix(".")
    out: list[str | int] = []
    for part in filter(None, path.split(".")):
        name = part.split("[", 1)[0]
        if name:
            out.append(name)
        out.extend(int(i) for i in _STEP.findall(part))
    return out


def variant_path(steps) -> str:
    """Spark's path text; an all-digit step stays an object key unless it is an int."""
    out = "$"
    for step in steps:
        out += f"[{step}]" if isinstance(step, int) else f"['{step}']"
    return out


def parse(c: Column) -> Column:
    return F.try_parse_json(c)


def at(v: Column, steps, kind: str = "variant") -> Column:
    if not steps:
        return v if kind == "variant" else F.try_variant_get(v, "$", kind)
    return F.try_variant_get(v, variant_path(steps), kind)


def kind_of(v: Column) -> Column:
    """STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID, OBJECT<..>, ARRAY<..> or null."""
    return F.schema_of_variant(v)


def is_present(v: Column) -> Column:
    """The path exists and is not JSON null."""
    return v.isNotNull() & ~F.is_variant_null(v)


def is_text(v: Column) -> Column:
    return kind_of(v) == "STRING"


def is_number(v: Column) -> Column:
    return _numeric(kind_of(v))


def _numeric(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def is_boolean(v: Column) -> Column:
    return kind_of(v) == "BOOLEAN"


def is_array(v: Column) -> Column:
    return kind_of(v).startswith("ARRAY")


def is_container(v: Column) -> Column:
    return F.substring(kind_of(v), 1, 5).isin("ARRAY", "OBJEC")


def facts(v: Column) -> Column:
    """What tests of a value ask for, worked out once: kind, text of a text, digits of a number."""

    def of(pair: Column) -> Column:
        value, kind = pair["v"], pair["kind"]
        return F.struct(
            value.alias("v"),
            kind.alias("kind"),
            leaf(kind != "VOID").alias("exists"),
            F.when(kind == "STRING", as_text(value)).alias("text"),
            F.when(_numeric(kind), as_text(value)).alias("number"),
        )

    return bound(bound(v, lambda x: F.struct(x.alias("v"), kind_of(x).alias("kind"))), of)


def as_text(v: Column) -> Column:
    """Scalars as their text, containers as JSON, JSON null as null."""
    return F.try_variant_get(v, "$", "string")


def parse_inside(v: Column) -> Column:
    """Text that holds a JSON object or array becomes that value."""
    inner = F.try_parse_json(F.when(is_text(v), as_text(v)))
    return F.coalesce(bound(inner, lambda i: F.when(is_container(i), i)), v)


def with_parsed(json: Column, test) -> Column:
    """Evaluate ``test(variant)`` with the text parsed once; false where it gives null."""
    return leaf(bound(parse(json), test))


def walk(json: Column, path: str) -> Column:
    """Follow a path; text on the way that holds JSON is parsed and entered."""
    return walk_in(parse_inside(parse(json)), path)


def walk_in(v: Column, path: str) -> Column:
    """As ``walk``, from a value that is parsed already."""
    steps = segments(path)
    for k, step in enumerate(steps):
        v = at(parse_inside(v) if k else v, [step])
    return v


def quoted(v: Column) -> Column:
    """JSON text of a value; null for missing and JSON null."""
    return F.when(is_present(v), F.to_json(v))
