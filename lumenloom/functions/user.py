"""User functions for SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenloom.operators.documents import item_size


def register_functions(spark: SparkSession, functions: dict | None = None) -> list[str]:
    """Make Python functions callable from spark.sql, by default those of this package."""
    functions = functions or {"item_size": item_size}
    for name, function in functions.items():
        spark.udf.register(name, function)
    return sorted(functions)


def list_functions(spark: SparkSession, pattern: str = "*", after: str = "", n: int | None = None) -> DataFrame:
    """The function names that fit a pattern with *, in text order; one page of them if n is given."""
    names = spark.sql(f"SHOW ALL FUNCTIONS LIKE '{pattern}'").where(F.col("function") > after)
    names = names.orderBy("function")
    return names if n is None else names.limit(n)
