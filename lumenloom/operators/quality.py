"""Data tests and column statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values: (table, column, check) of every layer.
MODEL_CHECKS = [
    ("stg_products", "id", "unique"),
    ("stg_products", "id", "not_null"),
    ("stg_products", "master_category", "not_null"),
    ("dim_produtos_analytics", "produto_id", "unique"),
    ("dim_produtos_analytics", "produto_id", "not_null"),
    ("dim_produtos_analytics", "categoria_principal", "not_null"),
    ("dim_produtos_analytics", "genero", "not_null"),
    ("fct_preparacao_ml", "produto_id", "unique"),
    ("fct_preparacao_ml", "produto_id", "not_null"),
    ("fct_preparacao_ml", "target_categoria_principal", "not_null"),
    ("fct_metricas_cores_bi", "categoria_principal", "not_null"),
    ("fct_metricas_cores_bi", "total_produtos", "not_null"),
]


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; nulls are not tested."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows in which the column is missing."""
    return df.where(F.col(column).isNull())


def run_checks(tables: dict[str, DataFrame], checks=MODEL_CHECKS) -> DataFrame:
    """(table_name, column_name, check_name, failures), one row per check.

    All not-null tests of a table share one pass over it.
    """
    parts = []
    for table in dict.fromkeys(t for t, _, _ in checks):
        df = tables[table]
        needed = [c for t, c, kind in checks if t == table and kind == "not_null"]
        if needed:
            nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in needed])
            rows = F.array(
                *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in needed]
            )
            parts.append(
                nulls.select(F.explode(rows).alias("r")).select(
                    F.lit(table).alias("table_name"),
                    "r.column_name",
                    F.lit("not_null").alias("check_name"),
                    "r.failures",
                )
            )
        for column in [c for t, c, kind in checks if t == table and kind == "unique"]:
            parts.append(
                check_unique(df, column)
                .agg(F.count("*").alias("failures"))
                .select(
                    F.lit(table).alias("table_name"),
                    F.lit(column).alias("column_name"),
                    F.lit("unique").alias("check_name"),
                    "failures",
                )
            )
    return reduce(DataFrame.unionByName, parts)


def require_checks(tables: dict[str, DataFrame], checks=MODEL_CHECKS) -> None:
    """Raise if any check fails; the failing checks are in the message."""
    failed = run_checks(tables, checks).where("failures > 0").limit(len(checks)).collect()
    if failed:
        text = ", ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in failed)
        raise AssertionError(f"data tests failed: {text}")


def column_stats(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """Per column (and per group of ``by``): rows, nulls, distinct, min, max, mean length.

    One pass over the data. Distinct counts are approximate (HyperLogLog); min and
    max are text. A column that does not exist yields a row with an error instead.
    """
    by = by or []
    known = [c for c in df.columns if c not in by]
    wanted = columns or known
    aggs, rows = [], []
    for c in wanted:
        if c not in known:
            rows.append(
                F.struct(
                    F.lit(c).alias("column_name"),
                    *[F.lit(None).cast("bigint").alias(x) for x in ("rows", "nulls", "approx_distinct")],
                    *[F.lit(None).cast("string").alias(x) for x in ("min", "max")],
                    F.lit(None).cast("double").alias("avg_length"),
                    F.lit("column not found").alias("error"),
                )
            )
            continue
        col, text = F.col(f"`{c}`"), F.col(f"`{c}`").cast("string")
        aggs.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count("*").alias("rows"),
                F.count_if(col.isNull()).alias("nulls"),
                F.approx_count_distinct(col).alias("approx_distinct"),
                F.min(col).cast("string").alias("min"),
                F.max(col).cast("string").alias("max"),
                F.avg(F.length(text)).alias("avg_length"),
                F.lit(None).cast("string").alias("error"),
            ).alias(f"s{len(aggs)}")
        )
        rows.append(F.col(f"s{len(aggs) - 1}"))
    if aggs:
        stats = df.groupBy(*by).agg(*aggs)
    else:
        stats = df.select(*by).distinct() if by else df.agg(F.count("*").alias("n"))
    return stats.select(*by, F.explode(F.array(*rows)).alias("s")).select(*by, "s.*")
