"""Routing of events and messages: rules, subscriptions, topics, choices, replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenloom.functions import json_paths as jp
from lumenloom.functions.booleans import bound, every, leaf, some
from lumenloom.functions.text import glob_regex, topic_regex
from lumenloom.operators.patterns import (
    attribute_test,
    body_test,
    envelope_test,
    event_test,
    has_envelope,
    tag_matches,
)


def match_rules(events: DataFrame, rules: list[dict]) -> DataFrame:
    """One row per event, matching enabled rule of its bus and target of that rule.

    A rule has name, bus, pattern, targets and, optionally, enabled.
    """
    live = [r for r in rules if r.get("enabled", True)]
    labelled = []
    for rule in live:
        test = lambda v, r=rule: leaf(F.col("bus") == r["bus"]) & event_test(r.get("pattern"), v)
        labelled += [(test, {"rule": rule["name"], "target": t}) for t in rule["targets"]]
    # events no rule can take are dropped before their detail is parsed
    possible = events.where(F.col("bus").isin(sorted({r["bus"] for r in live})))
    if live and all(has_envelope(r.get("pattern")) for r in live):
        possible = possible.where(some(envelope_test(r["pattern"]) for r in live))
    return tag_matches(possible, "detail", labelled, ("rule", "target"))


def fan_out(messages: DataFrame, subscriptions: list[dict]) -> DataFrame:
    """One row per message and subscription of its topic whose policy accepts it.

    A subscription has name, topic and, optionally, policy, scope (attributes or
    body) and pending; pending ones get nothing.
    """
    labelled = []
    for sub in subscriptions:
        if sub.get("pending"):
            continue

        def test(v: Column, s=sub) -> Column:
            policy = s.get("policy")
            by_body = s.get("scope", "attributes") == "body"
            accepted = body_test(policy, v) if by_body else attribute_test(policy, F.col("attributes"))
            return leaf(F.col("topic") == s["topic"]) & accepted

        labelled.append((test, {"subscription": sub["name"]}))
    topics = sorted({s["topic"] for s in subscriptions if not s.get("pending")})
    return tag_matches(messages.where(F.col("topic").isin(topics)), "body", labelled, ("subscription",))


def match_topic(df: DataFrame, rules: list[dict], topic: str = "topic") -> DataFrame:
    """One row per message and enabled rule whose topic filter accepts its topic."""
    hits = []
    for rule in rules:
        regex = topic_regex(rule["filter"])
        if rule.get("enabled", True) and regex is not None:
            hits.append(F.when(F.col(topic).rlike(regex), F.lit(rule["name"])))
    if not hits:
        return df.where(F.lit(False)).withColumn("rule", F.lit(None).cast("string"))
    return df.select("*", F.explode(F.array_compact(F.array(*hits))).alias("rule"))


# ── ordered choice rules ─────────────────────────────────────────────────────────


class _Value:
    """A JSON value under the conversions of choice rules.

    Missing and null read as the text 'null', the number 0 and false.
    """

    def __init__(self, v: Column):
        self.v = v
        self.present = leaf(jp.is_present(v))

    @property
    def text(self) -> Column:
        scalar = F.when(leaf(jp.is_container(self.v)), F.lit("")).otherwise(jp.as_text(self.v))
        return F.coalesce(F.when(self.present, scalar), F.lit("null"))

    @property
    def number(self) -> Column:
        truth = F.when(leaf(jp.is_boolean(self.v)), F.try_variant_get(self.v, "$", "boolean").cast("double"))
        return F.coalesce(truth, jp.as_text(self.v).try_cast("double"), F.lit(0.0))

    @property
    def truth(self) -> Column:
        from_text = F.trim(self.text) == "true"
        return F.when(leaf(jp.is_number(self.v)), self.number != 0).otherwise(from_text)


def _path(v: Column, path: str) -> Column:
    return jp.at(v, jp.segments(path))


# Comparison name -> (conversion, operator).
_COMPARISONS = {
    "StringEquals": ("text", "eq"),
    "NumericEquals": ("number", "eq"),
    "NumericLessThan": ("number", "lt"),
    "NumericGreaterThan": ("number", "gt"),
    "NumericLessThanEquals": ("number", "le"),
    "NumericGreaterThanEquals": ("number", "ge"),
    "BooleanEquals": ("truth", "eq"),
}
_APPLY = {
    "eq": lambda a, b: a == b,
    "lt": lambda a, b: a < b,
    "gt": lambda a, b: a > b,
    "le": lambda a, b: a <= b,
    "ge": lambda a, b: a >= b,
}


def choice_test(rule: dict, v: Column) -> Column:
    """One choice rule over parsed JSON: And / Or / Not or a comparison of a Variable."""
    if "And" in rule:
        return every(choice_test(r, v) for r in rule["And"])
    if "Or" in rule:
        return some(choice_test(r, v) for r in rule["Or"])
    if "Not" in rule:
        return ~choice_test(rule["Not"], v)
    node = _path(v, rule["Variable"])
    value = _Value(node)
    for name, (conversion, op) in _COMPARISONS.items():
        if name in rule:
            return leaf(_APPLY[op](getattr(value, conversion), F.lit(rule[name])))
        if f"{name}Path" in rule:
            other = _Value(_path(v, rule[f"{name}Path"]))
            return leaf(_APPLY[op](getattr(value, conversion), getattr(other, conversion)))
    if "StringMatches" in rule:
        return leaf(value.text.rlike(glob_regex(rule["StringMatches"])))
    tests = {
        "IsNull": lambda: ~value.present,
        "IsPresent": lambda: node.isNotNull(),
        "IsString": lambda: leaf(jp.is_text(node)),
        "IsNumeric": lambda: leaf(jp.is_number(node)),
        "IsBoolean": lambda: leaf(jp.is_boolean(node)),
    }
    for name, test in tests.items():
        if name in rule:
            return test() if rule[name] else ~test()
    return F.lit(False)


def route(df: DataFrame, rules: list[dict], default: str | None = None, json: str = "input") -> DataFrame:
    """Adds ``next``: the target of the first rule that holds, else the default."""

    def first_match(v: Column) -> Column:
        chain = None
        for rule in rules:
            test = choice_test(rule, v)
            chain = F.when(test, rule["Next"]) if chain is None else chain.when(test, rule["Next"])
        return chain.otherwise(F.lit(default)) if chain is not None else F.lit(default)

    return df.withColumn("next", bound(jp.parse(F.col(json)), first_match))


# ── archive and replay ───────────────────────────────────────────────────────────


def archive(events: DataFrame, pattern, path: str, time: str = "event_time", match=None) -> DataFrame:
    """Append the matching events to a Parquet archive by day; returns the archive."""
    from lumenloom.operators.patterns import match_event

    chosen = (match or match_event)(events, pattern)
    dated = chosen.withColumn("event_date", F.to_date(time))
    dated.write.mode("append").partitionBy("event_date").parquet(path)
    return events.sparkSession.read.parquet(path)


def replay(archived: DataFrame, start: str, end: str, time: str = "event_time") -> DataFrame:
    """Archived events of [start, end], both inclusive, in time order, ready to match again."""
    s, e = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    rows = archived.where(F.col(time).between(s, e))
    if "event_date" in archived.columns:
        rows = rows.where(F.col("event_date").between(F.to_date(s), F.to_date(e)))
    filled = F.coalesce("detail", F.lit("{}"))
    return rows.withColumn("detail", filled).orderBy(time)


def split_bad(df: DataFrame, parsed: Column) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows whose parsed value is there, and the rest for the dead letters."""
    marked = df.withColumn("parsed", parsed)
    return marked.where("parsed IS NOT NULL"), marked.where("parsed IS NULL").drop("parsed")


def over_received(deliveries: DataFrame, n: int, key: str = "message_id") -> DataFrame:
    """Messages delivered more than n times."""
    counts = deliveries.groupBy(key).agg(F.count("*").alias("receive_count"))
    return counts.where(F.col("receive_count") > n)


def shard_of(key: Column, n: int) -> Column:
    """Shard of a partition key: the first 32 bits of its MD5, modulo n."""
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % n).cast("int")


def enrich(df: DataFrame, reference: DataFrame, on) -> DataFrame:
    """Every row with what the reference table knows about it."""
    return df.join(reference, on, "left")


def enrich_with(df: DataFrame, function, schema: str) -> DataFrame:
    """Rows after a user function from pandas frame to pandas frame, batch by batch.

    A batch for which the function has nothing to say (None or no rows) is dropped.
    """

    def run(batches):
        for pdf in batches:
            out = function(pdf)
            if out is not None and len(out):
                yield out

    return df.mapInPandas(run, schema)
