"""Stateless stream flows: routes, dead letters, delivery and archives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenloom.functions.timebuckets import path_tokens
from lumenloom.sinks.line_files import write_lines


def with_routes(df: DataFrame, routes: dict[str, Column]) -> DataFrame:
    """One row per row and route whose test holds; a row without a route is consumed."""
    hits = [F.when(test, F.lit(name)) for name, test in routes.items()]
    return df.select("*", F.explode(F.array_compact(F.array(*hits))).alias("route"))


def route_stream(
    sdf: DataFrame,
    routes: dict[str, Column],
    path: str,
    reference: DataFrame | None = None,
    on=None,
    step: Callable[[DataFrame], DataFrame] | None = None,
):
    """A writer that filters, optionally enriches, and writes every route as a folder.

    All routes leave in one pass, as partitions of one write. Each batch has its own
    folder: one that runs again after a failure replaces it, so it counts once.
    ``step`` changes the rows before they are routed, such as ``enrich_with``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if reference is None else batch.join(reference, on, "left")
        rows = step(rows) if step else rows
        routed = with_routes(rows, routes)
        routed.write.mode("overwrite").partitionBy("route").parquet(f"{path}/batch={batch_id}")

    return sdf.writeStream.foreachBatch(write)


def dead_letter_stream(sdf: DataFrame, parsed: Column, path: str):
    """A writer that keeps good and bad rows apart, as partitions of one write.

    The parse runs once per row; bad rows keep their input and a null ``parsed``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("parsed", parsed).withColumn(
            "outcome", F.when(F.col("parsed").isNull(), "dead_letter").otherwise("ok")
        )
        marked.write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/batch={batch_id}")

    return sdf.writeStream.foreachBatch(write)


def delivery_lines(df: DataFrame, value: Column, ts: Column) -> DataFrame:
    """Records as lines without their line break, with the parts of their delivery path."""
    tokens = [c.alias(n) for n, c in path_tokens(ts).items()]
    return df.select(F.regexp_replace(value, "\n$", "").alias("value"), *tokens)


def deliver(df: DataFrame, value: Column, ts: Column, path: str, max_records: int = 1_000_000, max_bytes: int = 128 << 20):
    """Newline-delimited records below year=/month=/day=/hour= (UTC), batch or stream.

    A stream gives a writer to start; a batch is written at once. Each batch of a stream has its own
    folder; one that runs again replaces it. Records go to tasks by ranges of the hour and a hash, whose
    bounds are sampled from the records: a task takes many quiet hours or a part of a busy one. A task
    writes one file after the other and starts a new one when the hour changes or the file has
    ``max_records`` records or about ``max_bytes``.
    """
    parts = ["year", "month", "day", "hour"]

    def write(batch: DataFrame, target: str) -> None:
        lines = delivery_lines(batch, value, ts)
        folder = F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.coalesce(p, F.lit("none"))) for p in parts])
        placed = lines.select(folder.alias("folder"), "value").repartitionByRange("folder", F.xxhash64("value"))
        write_lines(placed.sortWithinPartitions("folder"), target, most_records=max_records, most_bytes=max_bytes)

    if not df.isStreaming:
        return write(df, path)
    return df.writeStream.foreachBatch(lambda batch, i: write(batch, f"{path}/batch={i}"))


def archive_stream(sdf: DataFrame, path: str, time: str):
    """A writer that appends events to a Parquet archive by day."""
    dated = sdf.withColumn("event_date", F.to_date(time))
    return dated.writeStream.format("parquet").option("path", path).partitionBy("event_date")
