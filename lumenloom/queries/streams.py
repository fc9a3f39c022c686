"""Streams over the given tables, run until their input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenloom.operators import devices, patterns, routing
from lumenloom.functions import json_paths as jp
from lumenloom.queries.base import EVENT_COLUMNS, METRIC_COLUMNS, spark_columns, table
from lumenloom.queries.registry import query
from lumenloom.queries.versions import FIFO_SQL, STATE_SQL, patch_rows
from lumenloom.session import shared_dir
from lumenloom.sources import connectors
from lumenloom.streaming import flows, runs, stateful


def _stream(spark, d, name):
    table(spark, d, name)  # sets the session zone
    return runs.read_stream(spark, f"{d}/{name}.parquet")


_ROUTES = "SELECT 'errors' AS route, event_id FROM events WHERE event_type = 'error' UNION ALL SELECT 'large', event_id FROM events WHERE value > 100"


@query("stream_filter_route", _ROUTES)
def stream_filter_route(spark, d):
    path = shared_dir(spark, "routes")
    routes = {"errors": F.col("event_type") == "error", "large": F.col("value") > 100}
    writer = flows.route_stream(_stream(spark, d, "events").select("event_id", "event_type", "value"), routes, path)
    runs.finish(writer, spark, "routes")
    return spark.read.parquet(path).select("route", "event_id")


@query(
    "stream_enrich_route",
    "SELECT 'known' AS route, event_id, c_mktsegment FROM events JOIN customer ON c_custkey = user_id WHERE event_type = 'purchase'",
)
def stream_enrich_route(spark, d):
    """Source, filter, enrichment from a table, target: one micro-batch write."""
    path = shared_dir(spark, "enriched")
    known = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    events = _stream(spark, d, "events").where("event_type = 'purchase'").select("event_id", "user_id")
    writer = flows.route_stream(events, {"known": F.col("c_mktsegment").isNotNull()}, path, known, "user_id")
    runs.finish(writer, spark, "enriched")
    return spark.read.parquet(path).select("route", "event_id", "c_mktsegment")


@query(
    "stream_function_route",
    "SELECT 'large' AS route, event_id, upper(event_type) AS kind FROM events WHERE value > 50",
)
def stream_function_route(spark, d):
    """A user function as a step of a route: rows it drops never reach a target."""

    def shout(pdf):
        pdf = pdf[pdf["value"] > 50]
        return pdf.assign(kind=pdf["event_type"].str.upper())[["event_id", "kind"]]

    path = shared_dir(spark, "functions")
    events = _stream(spark, d, "events").select("event_id", "event_type", "value")
    step = lambda rows: routing.enrich_with(rows, shout, "event_id long, kind string")
    writer = flows.route_stream(events, {"large": F.col("kind").isNotNull()}, path, step=step)
    runs.finish(writer, spark, "functions")
    return spark.read.parquet(path).select("route", "event_id", "kind")


@query(
    "stream_record_filter",
    "SELECT event_id FROM events WHERE event_type IN ('error', 'view') AND CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) < 20",
)
def stream_record_filter(spark, d):
    """A record pattern on a stream, its result as a table."""
    rows = _stream(spark, d, "events").selectExpr(*spark_columns(EVENT_COLUMNS))
    filters = [{"kind": ["error", "view"], "k": [{"numeric": ["<", 20]}]}]
    return runs.stream_to_table(patterns.match_record(rows, filters, "detail").select("event_id"), "records")


@query(
    "dead_letter_route",
    "SELECT CASE WHEN event_id % 9 = 0 THEN 'dead_letter' ELSE 'ok' END AS outcome, event_id,"
    " CASE WHEN event_id % 9 = 0 THEN NULL ELSE regexp_extract(props, '([0-9]+)', 1) END AS k FROM events",
)
def dead_letter_route(spark, d):
    path = shared_dir(spark, "dead-letters")
    # one record in nine is broken
    body = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    events = _stream(spark, d, "events").select("event_id", body.alias("body"))
    parsed = jp.at(jp.parse(F.col("body")), ["k"], "string")
    runs.finish(flows.dead_letter_stream(events, parsed, path), spark, "dead-letters")
    return spark.read.parquet(path).select("outcome", "event_id", F.col("parsed").alias("k"))


@query(
    "ndjson_delivery_sink",
    "SELECT CAST(strftime(ts, '%Y') AS INTEGER) AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour,"
    " count(*) AS records, CAST(sum(strlen(props) + 1) AS BIGINT) AS bytes FROM events GROUP BY 1, 2, 3, 4",
)
def ndjson_delivery_sink(spark, d):
    path = shared_dir(spark, "delivered")
    events = _stream(spark, d, "events")
    # some records bring their line break, some do not
    value = F.when(F.col("event_id") % 2 == 0, F.concat("props", F.lit("\n"))).otherwise(F.col("props"))
    writer = flows.deliver(events, value, F.col("ts").cast("timestamp"), path)
    runs.finish(writer, spark, "delivered")
    lines = spark.read.schema("value string, batch int, year int, month string, day string, hour string").text(path)
    return lines.groupBy("year", "month", "day", "hour").agg(
        F.count("*").alias("records"), F.sum(F.octet_length("value") + 1).alias("bytes")
    )


@query(
    "stream_metrics",
    """SELECT (s // 3600) * 3600 AS period_start, metric, sum(n) AS sample_count,
              CAST(round(CAST(sum(total) AS DECIMAL(38,10)), 6) AS DOUBLE) AS sum,
              CAST(round(CAST(sum(total) / sum(n) AS DECIMAL(38,10)), 6) AS DOUBLE) AS average,
              min(low) AS minimum, max(high) AS maximum, coalesce(max(unit), 'None') AS unit
       FROM (SELECT event_type AS metric, epoch_us(ts) // 1000000 AS s, CASE event_id % 3 WHEN 0 THEN 'Count' END AS unit,
                    CASE WHEN event_id % 10 = 0 THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END AS n,
                    CASE WHEN event_id % 10 = 0 THEN value * 4 ELSE value END AS total,
                    CASE WHEN event_id % 10 = 0 THEN value / 2 ELSE value END AS low,
                    CASE WHEN event_id % 10 = 0 THEN value * 2 ELSE value END AS high FROM events)
       GROUP BY 1, 2
       HAVING (s // 3600) * 3600 + 3600 <= (SELECT epoch_us(max(ts)) // 1000 FROM events) / 1000.0 - 600""",
)
def stream_metrics(spark, d):
    events = _stream(spark, d, "events")
    data = events.selectExpr("CAST(ts AS TIMESTAMP) AS event_time", *spark_columns(METRIC_COLUMNS))
    stats = stateful.stream_metrics(data, "event_time", 3600, "10 minutes", ["metric"])
    out = runs.stream_to_table(stats, "metrics")
    return out.withColumns(
        {c: F.round(F.col(c).cast("decimal(38,10)"), 6).cast("double") for c in ("sum", "average")}
    )


@query("stream_fifo_dedup", FIFO_SQL)
def stream_fifo_dedup(spark, d):
    path = shared_dir(spark, "fifo")
    events = _stream(spark, d, "events").select("event_id", "ts", "event_type")
    runs.finish(stateful.stream_fifo_dedup(events, ["event_type"], "ts", path, 300, ["event_id"]), spark, "fifo")
    return spark.read.parquet(f"{path}/rows").select("event_id", "event_type")


@query(
    "stream_cdc",
    "SELECT o_custkey, o_orderkey, CASE WHEN lag(o_orderkey) OVER w IS NULL THEN 'INSERT' ELSE 'MODIFY' END AS event_name,"
    " o_orderstatus AS new_status, lag(o_orderstatus) OVER w AS old_status FROM orders"
    " WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)",
)
def stream_cdc(spark, d):
    path = shared_dir(spark, "cdc")
    orders = _stream(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    runs.finish(stateful.stream_cdc(orders, ["o_custkey"], "o_orderkey", path, 1_000_000), spark, "cdc")
    events = stateful.latest_events(spark.read.parquet(f"{path}/events"), ["o_custkey"], "o_orderkey")
    return events.select(
        "o_custkey",
        "o_orderkey",
        "event_name",
        F.col("new_image.o_orderstatus").alias("new_status"),
        F.col("old_image.o_orderstatus").alias("old_status"),
    )


@query("stream_device_state", STATE_SQL)
def stream_device_state(spark, d):
    path = shared_dir(spark, "devices")
    writer = stateful.stream_device_state(patch_rows(_stream(spark, d, "events")), path)
    runs.finish(writer, spark, "devices")
    return devices.merge_state(spark.read.parquet(f"{path}/patches"))


@query(
    "kafka_source",
    "SELECT event_type AS topic, CAST(user_id % 8 AS INTEGER) AS partition, event_id AS \"offset\","
    " CAST(user_id AS VARCHAR) AS key, props AS value FROM events"
    " WHERE CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) >= 50",
)
def kafka_source(spark, d):
    """Records in the connector's layout (binary key and value), decoded, filtered, delivered.

    The connector is not on this class path, so Spark derives its rows from a table.
    """
    raw = _stream(spark, d, "events").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
    )
    records = patterns.match_record(connectors.decode_records(raw), [{"k": [{"numeric": [">=", 50]}]}], "value")
    out = runs.stream_to_table(records, "kafka")
    return out.select("topic", "partition", "offset", "key", "value")
