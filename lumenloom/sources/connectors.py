"""Thin wrappers over connectors whose drivers the cluster supplies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A Kafka topic as a stream: key and value as text, with partition and offset."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    return decode_records(reader.options(**options).load())


def decode_records(raw: DataFrame) -> DataFrame:
    return raw.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    split: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """A query or table over JDBC.

    ``split`` = (column, low, high, parts) reads it in parallel; without it the
    whole result comes through one connection.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if split is None:
        return reader.option("query", query).load()
    column, low, high, parts = split
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", parts)
        .load()
    )
