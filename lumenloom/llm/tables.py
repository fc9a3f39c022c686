"""Written intermediates and connected components, shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenloom.session import shared_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the folder all executors share: computed once, kept if one is lost."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest id reachable from each id of ``edges`` (a, b): columns id, component.

    Large-star and small-star steps, each a pair of combining aggregates and a join, until no edge
    changes. Every round is a written table, so lineage stays short. An id with very many edges is
    spread by the join's skew handling, since the aggregates hold one row per id.
    """
    edges = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges"
    )
    before = None
    while True:
        # large star: larger neighbours of each node point to its smallest neighbour or itself
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: smaller neighbours point to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = written(small.where("u <> v").distinct(), "edges")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
        before = mark
