"""Metric statistics.

A metric table has: namespace, metric, dimensions (MAP), ts (epoch seconds), value,
sample_count, sum, minimum, maximum, unit.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenloom.functions.booleans import every, known, some
from lumenloom.functions.collections import dimension_key, holds_all

DEFAULT_PERIOD = 60  # fixed value: period in seconds of a query that names none


def fill_statistics(df: DataFrame) -> DataFrame:
    """A datum with only a value counts as one sample of it; data without a unit column have none."""
    if "unit" not in df.columns:
        df = df.withColumn("unit", F.lit(None).cast("string"))
    scalar = (F.coalesce("sample_count", F.lit(0.0)) == 0) & (F.coalesce("sum", F.lit(0.0)) == 0)
    value = F.col("value")
    return df.withColumns(
        {
            "sample_count": F.when(scalar, 1.0).otherwise(F.col("sample_count")),
            "sum": F.when(scalar, value).otherwise(F.col("sum")),
            "minimum": F.when(scalar, value).otherwise(F.col("minimum")),
            "maximum": F.when(scalar, value).otherwise(F.col("maximum")),
        }
    )


def period_start(ts: Column, period: int) -> Column:
    """Start of the period; floor division, so it holds before 1970 too."""
    return F.floor(ts / F.lit(period)).cast("bigint") * F.lit(period)


def statistics(rows: DataFrame, *keys: str) -> DataFrame:
    """Statistics per group of ``keys``, in two steps.

    The first sums per group and unit and holds numbers only, so it hashes and
    combines before the shuffle; the second picks the unit among its few rows.
    """
    per_unit = rows.groupBy(*keys, "unit").agg(
        F.sum("sample_count").alias("sample_count"),
        F.sum("sum").alias("sum"),
        F.min("minimum").alias("minimum"),
        F.max("maximum").alias("maximum"),
        F.min("ts").alias("first_ts"),
    )
    named = F.when(F.trim("unit") != "", F.col("unit"))
    first_unit = F.min_by(named, F.when(named.isNotNull(), F.struct("first_ts", "unit")))
    samples, total = F.sum("sample_count"), F.sum("sum")
    return per_unit.groupBy(*keys).agg(
        samples.alias("sample_count"),
        total.alias("sum"),
        F.when(samples > 0, total / samples).otherwise(0.0).alias("average"),
        F.min("minimum").alias("minimum"),
        F.max("maximum").alias("maximum"),
        F.coalesce(first_unit, F.lit("None")).alias("unit"),
    )


def _in_range(df: DataFrame, start: int | None, end: int | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col("ts") >= start)
    if end is not None:
        df = df.where(F.col("ts") <= end)
    return df


def _selection(namespace: str, metric: str, dimensions: dict[str, str], unit: str | None) -> Column:
    """One metric with exactly these dimensions and, if a real one is given, this unit."""
    tests = [
        known(F.col("namespace") == namespace, F.col("namespace")),
        known(F.col("metric") == metric, F.col("metric")),
        F.coalesce(F.size("dimensions"), F.lit(0)) == len(dimensions),
    ]
    if dimensions:
        tests.append(holds_all(F.col("dimensions"), dimensions))
    if unit and unit.strip() and unit != "None":
        tests.append(known(F.col("unit") == unit, F.col("unit")))
    return every(tests)


def metric_statistics(
    df: DataFrame,
    namespace: str,
    metric: str,
    period: int,
    dimensions: dict[str, str] | None = None,
    start: int | None = None,
    end: int | None = None,
    unit: str | None = None,
) -> DataFrame:
    """Statistics of one metric per period; exactly these dimensions, both ends inclusive."""
    chosen = _in_range(df, start, end).where(_selection(namespace, metric, dimensions or {}, unit))
    rows = fill_statistics(chosen).withColumn("period_start", period_start(F.col("ts"), period))
    return statistics(rows, "period_start").orderBy("period_start")


@dataclass(frozen=True)
class MetricQuery:
    id: str
    namespace: str
    metric: str
    stat: str
    period: int = DEFAULT_PERIOD
    dimensions: dict[str, str] = field(default_factory=dict)
    unit: str | None = None
    label: str | None = None
    return_data: bool = True


def _value_of(stat: str) -> Column:
    # any percentile (pNN) yields the maximum; an unknown name the average
    names = {
        "Average": "average", "Sum": "sum", "Minimum": "minimum",
        "Maximum": "maximum", "SampleCount": "sample_count",
    }
    return F.col(names.get(stat, "maximum" if stat.startswith("p") else "average"))


def metric_data(
    df: DataFrame, queries: list[MetricQuery], start: int | None = None, end: int | None = None
) -> DataFrame:
    """(id, label, period_start, value) of several queries, one statistic each.

    All queries share one pass: a row is marked with the selections it belongs to
    and aggregated once per selection and period.
    """
    asked = [q for q in queries if q.return_data]
    selections = list(dict.fromkeys(_selection_of(q) for q in asked))
    tests = [_selection(n, m, dict(dims), unit) for n, m, _, dims, unit in selections]
    hits = F.array(
        *[
            F.when(test, F.struct(F.lit(i).alias("selection"), period_start(F.col("ts"), s[2]).alias("period_start")))
            for i, (test, s) in enumerate(zip(tests, selections))
        ]
    )
    # the lists reach the scan; the exact tests decide row by row
    named = F.col("namespace").isin(sorted({q.namespace for q in asked})) & F.col("metric").isin(
        sorted({q.metric for q in asked})
    )
    rows = fill_statistics(_in_range(df, start, end).where(named & some(tests)))
    marked = rows.select("*", F.explode(F.array_compact(hits)).alias("hit")).select(*rows.columns, "hit.*")
    stats = statistics(marked, "selection", "period_start")
    results = F.array(
        *[
            F.when(
                F.col("selection") == selections.index(_selection_of(q)),
                F.struct(
                    F.lit(q.id).alias("id"),
                    F.lit(q.label or q.metric).alias("label"),
                    _value_of(q.stat).alias("value"),
                ),
            )
            for q in asked
        ]
    )
    out = stats.select("period_start", F.explode(F.array_compact(results)).alias("r"))
    return out.select("r.id", "r.label", "period_start", "r.value")


def _selection_of(q: MetricQuery) -> tuple:
    return q.namespace, q.metric, q.period or DEFAULT_PERIOD, tuple(sorted(q.dimensions.items())), q.unit


def list_metrics(
    df: DataFrame,
    namespace: str | None = None,
    metric: str | None = None,
    dimensions: dict[str, str] | None = None,
) -> DataFrame:
    """Distinct (namespace, metric, dimension set) that hold all the wanted dimensions."""
    out = df
    if namespace:
        out = out.where(F.col("namespace") == namespace)
    if metric:
        out = out.where(F.col("metric") == metric)
    if dimensions:
        out = out.where(holds_all(F.col("dimensions"), dimensions))
    key = F.coalesce(dimension_key(F.col("dimensions")), F.lit(""))
    return out.select("namespace", "metric", key.alias("dimensions")).distinct()
