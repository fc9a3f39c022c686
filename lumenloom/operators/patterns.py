"""Event, record and message patterns turned into one boolean column each.

A pattern is read once on the driver; the rows only see built-in expressions.
The four matchers share their shape (AND over fields, OR inside an array) and
differ in what a value is and in what a missing value does.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from decimal import Decimal
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenloom.functions import json_paths as jp
from lumenloom.functions.booleans import bound, every, known, leaf, some
from lumenloom.functions.numbers import compare_to



def read_pattern(pattern: str | dict | None):
    """A pattern as Python values, numbers exact; None for no pattern."""
    if pattern is None or isinstance(pattern, dict):
        return pattern
    return json.loads(pattern, parse_float=Decimal) if pattern.strip() else None


def _is_number(x) -> bool:
    return isinstance(x, (int, float, Decimal)) and not isinstance(x, bool)


def _text(x) -> str:
    """A JSON scalar as text."""
    return str(x).lower() if isinstance(x, bool) else str(x)


def _in_ranges(number: Column, conditions) -> Column:
    """[">=", 100, "<", 200]: every operator with the operand that follows it."""
    if not isinstance(conditions, list):
        return F.lit(False)
    tests = []
    for op, operand in zip(conditions[::2], conditions[1::2]):
        known = op in ("=", ">", ">=", "<", "<=") and _is_number(operand)
        tests.append(leaf(compare_to(number, op, operand)) if known else F.lit(False))
    return number.isNotNull() & every(tests)


# ── bus events: every value is text, missing and JSON null are the same ──────────


def _bus_element(element, value: Column) -> Column:
    if isinstance(element, str):
        return known(value == element, value)
    if element is None:
        return value.isNull()
    if isinstance(element, dict):
        if "prefix" in element:
            return known(value.startswith(element["prefix"]), value)
        if "suffix" in element:
            return known(value.endswith(element["suffix"]), value)
        if "equals-ignore-case" in element:
            return known(F.lower(value) == element["equals-ignore-case"].lower(), value)
        but = element.get("anything-but")
        if isinstance(but, list):
            return known(~value.isin([v for v in but if isinstance(v, str)]), value)
        if isinstance(but, dict) and "prefix" in but:
            return known(~value.startswith(but["prefix"]), value)
        if "exists" in element:
            return value.isNotNull() if element["exists"] else value.isNull()
    return F.lit(False)  # numbers and other literals match nothing here


def _bus_array(elements: list, value: Column) -> Column:
    return some(_bus_element(e, value) for e in elements)


def _bus_text(v: Column) -> Column:
    return F.when(leaf(jp.is_container(v)), F.lit("")).otherwise(jp.as_text(v))


def _bus_detail(v: Column, pattern: dict) -> Column:
    tests = []
    for key, expected in pattern.items():
        if key == "$or" and isinstance(expected, list):
            tests.append(some(_bus_detail(v, p) for p in expected))
        elif isinstance(expected, list):
            text = bound(jp.at(v, [key]), _bus_text)
            tests.append(bound(text, partial(_bus_array, expected)))
        elif isinstance(expected, dict):
            tests.append(bound(jp.at(v, [key]), partial(_bus_inner, expected)))
    return every(tests)


def _bus_inner(pattern: dict, value: Column) -> Column:
    entered = bound(jp.parse_inside(value), lambda v: _bus_detail(v, pattern))
    return leaf(jp.is_present(value)) & entered


# Pattern key -> event column.
ENVELOPE = {"source": "source", "detail-type": "detail_type", "account": "account", "region": "region"}


def envelope_test(pattern: str | dict | None) -> Column:
    """What a bus pattern asks of plain columns; $or and detail are left out."""
    pattern = read_pattern(pattern) or {}
    tests = [
        _bus_array(pattern[key], F.col(column))
        for key, column in ENVELOPE.items()
        if isinstance(pattern.get(key), list)
    ]
    if isinstance(pattern.get("resources"), list):
        elements = pattern["resources"]
        tests.append(leaf(F.exists("resources", lambda r: _bus_array(elements, r))))
    return every(tests)


def has_envelope(pattern: str | dict | None) -> bool:
    """Whether a bus pattern asks anything of plain columns."""
    pattern = read_pattern(pattern) or {}
    return any(isinstance(pattern.get(key), list) for key in (*ENVELOPE, "resources"))


def event_test(pattern: str | dict | None, detail: Column) -> Column:
    """The test of a bus pattern; ``detail`` is the parsed detail (VARIANT).

    Only source, detail-type, account, region, detail, resources and $or count,
    every other key of the pattern is ignored.
    """
    pattern = read_pattern(pattern) or {}
    tests = [envelope_test(pattern)]
    if isinstance(pattern.get("$or"), list):
        tests.append(some(event_test(p, detail) for p in pattern["$or"]))
    if isinstance(pattern.get("detail"), dict):
        tests.append(detail.isNotNull() & _bus_detail(detail, pattern["detail"]))
    return every(tests)


def match_event(df: DataFrame, pattern: str | dict, detail: str = "detail") -> DataFrame:
    """Events a bus pattern accepts; plain columns are tested first, in the scan if they can."""
    pattern = read_pattern(pattern) or {}
    chosen = df.where(envelope_test(pattern))
    if isinstance(pattern.get("detail"), dict) or isinstance(pattern.get("$or"), list):
        chosen = chosen.where(jp.with_parsed(F.col(detail), lambda v: event_test(pattern, v)))
    return chosen


# ── records: typed values, "anything-but" accepts a missing one ──────────────────


def _record_element(element, fact: Column) -> Column:
    exists, text, number = fact["exists"], fact["text"], fact["number"]
    if isinstance(element, str):
        return leaf(text == element)
    if element is None:
        return ~exists
    if _is_number(element):
        return leaf(compare_to(number, "=", element))
    if isinstance(element, dict):
        if "prefix" in element:
            return leaf(text.startswith(element["prefix"]))
        if "suffix" in element:
            return leaf(text.endswith(element["suffix"]))
        if "equals-ignore-case" in element:
            return leaf(F.lower(text) == element["equals-ignore-case"].lower())
        if "anything-but" in element:
            but = element["anything-but"]
            if isinstance(but, list):
                return ~exists | ~_any_equal(but, fact)
            if isinstance(but, dict) and "prefix" in but:
                return ~exists | leaf(~text.startswith(but["prefix"]))
            if isinstance(but, str):
                return ~exists | leaf(text != but)
        if "exists" in element:
            return exists if element["exists"] else ~exists
        if "numeric" in element:
            return _in_ranges(number, element["numeric"])
    return F.lit(False)


def _any_equal(literals: list, fact: Column) -> Column:
    """The value is one of the texts or numbers."""
    hits = [leaf(fact["text"] == b) for b in literals if isinstance(b, str)]
    return some(hits + [leaf(compare_to(fact["number"], "=", b)) for b in literals if _is_number(b)])


def _record_elements(elements: list, fact: Column) -> Column:
    return some(_record_element(e, fact) for e in elements)


def _record_node(pattern: dict, v: Column) -> Column:
    tests = []
    for key, expected in pattern.items():
        value = jp.at(v, [key])
        if isinstance(expected, list):
            tests.append(bound(jp.facts(value), partial(_record_elements, expected)))
        elif isinstance(expected, dict):
            inside = bound(value, jp.parse_inside)
            tests.append(bound(inside, partial(_record_node, expected)))
        else:
            return F.lit(False)  # a bare scalar is no pattern
    return every(tests)


def record_test(filters: list, record: Column) -> Column:
    """Any filter accepts the record; no filter at all accepts every record."""
    if not filters:
        return F.lit(True)
    patterns = [read_pattern(f) for f in filters]
    known_form = [p for p in patterns if p is None or isinstance(p, dict)]
    return some(F.lit(True) if p is None else _record_node(p, record) for p in known_form)


def match_record(df: DataFrame, filters: list, record: str = "record") -> DataFrame:
    return df.where(jp.with_parsed(F.col(record), lambda v: record_test(filters, v)))


# ── message attributes: a text map ───────────────────────────────────────────────


def _attribute_rule(rule, value: Column) -> Column:
    number = F.trim(value)
    if isinstance(rule, str):
        return leaf(value == rule)
    if _is_number(rule):
        return leaf(compare_to(number, "=", rule))
    if isinstance(rule, dict):
        if "exists" in rule:
            return value.isNotNull() if rule["exists"] else value.isNull()
        if "prefix" in rule:
            return leaf(value.startswith(rule["prefix"]))
        if "anything-but" in rule:
            but = rule["anything-but"]
            but = but if isinstance(but, list) else [but]
            return leaf(~value.isin([_text(b) for b in but]))
        if "numeric" in rule and len(rule["numeric"]) % 2 == 0:
            return _in_ranges(number, rule["numeric"])
    return F.lit(False)


def attribute_test(policy: str | dict | None, attributes: Column) -> Column:
    """Every key of the policy must hold; a policy that is no object delivers nothing."""
    try:
        policy = read_pattern(policy)
    except ValueError:
        return F.lit(False)
    if policy is None:
        return F.lit(True)
    if not isinstance(policy, dict):
        return F.lit(False)
    tests = []
    for key, rules in policy.items():
        if not isinstance(rules, list):
            return F.lit(False)
        value = F.try_element_at(attributes, F.lit(key))
        tests.append(some(_attribute_rule(r, value) for r in rules))
    return every(tests)


def match_attributes(df: DataFrame, policy, attributes: str = "attributes") -> DataFrame:
    return df.where(attribute_test(policy, F.col(attributes)))


# ── message bodies: typed values, arrays match per element ───────────────────────


def _body_rule(rule, fact: Column) -> Column:
    text, number, v = fact["text"], fact["number"], fact["v"]
    if isinstance(rule, bool):
        truth = F.when(fact["kind"] == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        return leaf(truth == F.lit(rule))
    if isinstance(rule, str):
        return leaf(text == rule)
    if _is_number(rule):
        return leaf(compare_to(number, "=", rule))
    if rule is None:
        return leaf(fact["kind"] == "VOID")
    if isinstance(rule, dict):
        if "exists" in rule:
            filled = fact["exists"] & ~leaf(text == "") & ~leaf(F.to_json(v).isin("{}", "[]"))
            return filled if rule["exists"] else ~filled
        if "prefix" in rule:
            return leaf(text.startswith(rule["prefix"]))
        if "anything-but" in rule:
            but = rule["anything-but"]
            if isinstance(but, list):
                return fact["exists"] & ~_any_equal(but, fact)
            return fact["exists"] & ~leaf(text == but) if isinstance(but, str) else F.lit(False)
        if "numeric" in rule and len(rule["numeric"]) % 2 == 0:
            return _in_ranges(number, rule["numeric"])
    return F.lit(False)


def _body_rules(rules: list, fact: Column) -> Column:
    """Rules against a value; against an array they are tried on every element."""

    def on_array(elements: Column) -> Column:
        tests = []
        for rule in rules:
            if isinstance(rule, dict) and "exists" in rule:
                filled = F.size(elements) > 0
                tests.append(filled if rule["exists"] else ~filled)
            else:
                tests.append(leaf(F.exists(elements, partial(_body_rule, rule))))
        return some(tests)

    items = F.try_variant_get(fact["v"], "$", "array<variant>")
    on_value = some(_body_rule(r, fact) for r in rules)
    is_array = leaf(fact["kind"].startswith("ARRAY"))
    return F.when(is_array, bound(F.transform(items, jp.facts), on_array)).otherwise(on_value)


def _body_policy(policy: dict, v: Column) -> Column:
    tests = []
    for key, rules in policy.items():
        value = jp.at(v, [key])
        if isinstance(rules, list):
            tests.append(bound(jp.facts(value), partial(_body_rules, rules)))
        elif isinstance(rules, dict):
            tests.append(bound(value, partial(_body_policy, rules)))
        else:
            return F.lit(False)
    return every(tests)


def body_test(policy: str | dict | None, body: Column) -> Column:
    """The test of a policy on a parsed body (VARIANT); invalid JSON is never delivered."""
    try:
        policy = read_pattern(policy)
    except ValueError:
        return F.lit(False)
    if policy is None:
        return F.lit(True)
    return body.isNotNull() & _body_policy(policy, body) if isinstance(policy, dict) else F.lit(False)


def match_body(df: DataFrame, policy, body: str = "body") -> DataFrame:
    return df.where(jp.with_parsed(F.col(body), lambda v: body_test(policy, v)))


# ── many patterns at once ────────────────────────────────────────────────────────


def _labels(v: Column, labelled: list[tuple[Callable, dict]]) -> Column:
    """The labels whose test holds for a row, null in the place of the others."""
    return F.array(
        *[
            F.when(test(v), F.struct(*[F.lit(t).alias(k) for k, t in label.items()]))
            for test, label in labelled
        ]
    )


def tag_matches(
    df: DataFrame, json_column: str, labelled: list[tuple[Callable, dict]], names: tuple[str, ...]
) -> DataFrame:
    """One output row per input row and matching entry of ``labelled``, with its ``names``.

    Each entry is (test of the parsed JSON, label columns as text). The list is
    rule metadata, so there is no join: a row is read and parsed once, however many
    entries there are, and carries an array of the labels whose test holds.
    """
    if not labelled:
        return df.where(F.lit(False)).select(*df.columns, *[F.lit(None).cast("string").alias(n) for n in names])
    hits = bound(jp.parse(F.col(json_column)), lambda v: _labels(v, labelled))
    tagged = df.select("*", F.explode(F.array_compact(hits)).alias("_hit"))
    return tagged.select(*df.columns, *[F.col("_hit")[n].alias(n) for n in names])
