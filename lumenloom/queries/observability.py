"""Log search and metric statistics over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenloom.operators import logs as lg
from lumenloom.operators import metrics as mt
from lumenloom.queries.base import LOGS, METRICS, logs, metrics
from lumenloom.queries.registry import query

# the month the events cover is January 2024; a search takes a part of it, both ends inclusive
START_MS, END_MS = 1704412800000, 1705708800000  # 5 January and 20 January, midnight
IN_RANGE = f"timestamp BETWEEN {START_MS} AND {END_MS}"


@query(
    "log_filter",
    f"SELECT log_stream, timestamp, message, event_id FROM ({LOGS}) WHERE log_group = 'error' AND {IN_RANGE}"
    " AND log_stream IN ('user-1', 'user-2', 'user-3') AND contains(message, '\"zone\":\"z1\"')",
)
def log_filter(spark, d):
    found = lg.filter_logs(
        logs(spark, d), "error", ["user-1", "user-2", "user-3"], START_MS, END_MS, '"zone":"z1"', limit=None
    )
    return found.select("log_stream", "timestamp", "message", "event_id")


@query(
    "log_where",
    f'SELECT f_time AS "@timestamp", f_job AS "params.job_id", event_id AS "@ptr" FROM ({LOGS})'
    f" WHERE log_group IN ('error', 'click') AND {IN_RANGE} AND f_level = 'error' AND coalesce(f_zone, '') <> 'z1'",
)
def log_where(spark, d):
    search = lg.log_query(logs(spark, d), ["error", "click", "error"], START_MS, END_MS)
    search = search.where_eq("level", "error").where_ne("zone", "z1")
    return search.fields("@timestamp", "params.job_id").run()


@query(
    "log_fields",
    f'SELECT f_time AS "@timestamp", strftime(make_timestamp(ingestion_time * 1000), \'%Y-%m-%d %H:%M:%S.%g\') AS "@ingestionTime",'
    f" message AS \"@message\", coalesce(f_zone, '') AS zone, f_job AS \"params.job_id\", f_count AS count,"
    f" '' AS missing, event_id AS \"@ptr\" FROM ({LOGS}) WHERE log_group = 'view'",
)
def log_fields(spark, d):
    search = lg.log_query(logs(spark, d), ["view"])
    return search.fields(
        "@timestamp", "@ingestionTime", "@message", "zone", "params.job_id", "count", "missing"
    ).run()


@query(
    "log_sort",
    f"SELECT f_count AS count, event_id AS \"@ptr\" FROM ({LOGS}) WHERE log_group IN ('purchase', 'signup')"
    " ORDER BY f_count DESC, timestamp, sequence, event_id LIMIT 500",
)
def log_sort(spark, d):
    # fields sort as text: "9" comes before "10" in descending order
    search = lg.log_query(logs(spark, d), ["purchase", "signup"])
    return search.sort("@timestamp").sort("count", desc=True).limit(500).fields("count").run()


@query(
    "log_dedup",
    f"""SELECT coalesce(f_zone, '') AS zone, f_job AS "params.job_id", f_time AS "@timestamp", event_id AS "@ptr"
        FROM (SELECT *, row_number() OVER (PARTITION BY f_zone, f_job ORDER BY timestamp DESC, sequence DESC, event_id DESC) AS n
              FROM ({LOGS}) WHERE log_group IN ('click', 'view')) WHERE n = 1""",
)
def log_dedup(spark, d):
    search = lg.log_query(logs(spark, d), ["click", "view"]).dedup("zone", "params.job_id")
    return search.fields("zone", "params.job_id", "@timestamp").run()


@query(
    "log_dedup_by_text",
    f"""SELECT coalesce(f_zone, '') AS zone, f_count AS count, event_id AS "@ptr"
        FROM (SELECT *, row_number() OVER (PARTITION BY f_zone ORDER BY f_count DESC, timestamp, sequence, event_id) AS n
              FROM ({LOGS})) WHERE n = 1""",
)
def log_dedup_by_text(spark, d):
    groups = ["click", "view", "error", "purchase", "signup"]
    search = lg.log_query(logs(spark, d), groups).dedup("zone").sort("count", desc=True)
    return search.fields("zone", "count").run()


@query(
    "query_counters",
    f"SELECT count(*) AS records_scanned, count(*) FILTER (WHERE f_zone = 'z2') AS records_matched FROM ({LOGS})"
    f" WHERE log_group IN ('error', 'view') AND {IN_RANGE}",
)
def query_counters(spark, d):
    search = lg.log_query(logs(spark, d), ["error", "view"], START_MS, END_MS).where_eq("zone", "z2")
    return lg.query_counters(search)


@query(
    "log_stream_stats",
    f"SELECT log_group, log_stream, min(timestamp) AS first_event, max(timestamp) AS last_event,"
    f" max(ingestion_time) AS last_ingestion, CAST(sum(strlen(message) + 26) AS BIGINT) AS stored_bytes FROM ({LOGS}) GROUP BY 1, 2",
)
def log_stream_stats(spark, d):
    return lg.log_stream_stats(logs(spark, d))


_EDGE = (1705104000000, 0, "")  # 13 January, midnight


@query(
    "log_page",
    f"SELECT * FROM (SELECT 'forward' AS page, timestamp, event_id FROM ({LOGS}) WHERE timestamp >= {_EDGE[0]}"
    " ORDER BY timestamp, sequence, event_id LIMIT 200)"
    f" UNION ALL SELECT * FROM (SELECT 'backward', timestamp, event_id FROM ({LOGS}) WHERE timestamp < {_EDGE[0]}"
    " ORDER BY timestamp DESC, sequence DESC, event_id DESC LIMIT 200)"
    f" UNION ALL SELECT * FROM (SELECT 'tail', timestamp, event_id FROM ({LOGS})"
    " ORDER BY timestamp DESC, sequence DESC, event_id DESC LIMIT 50)",
)
def log_page(spark, d):
    rows = logs(spark, d)
    pages = {
        "forward": lg.log_page(rows, 200, after=_EDGE),
        "backward": lg.log_page(rows, 200, before=_EDGE),
        "tail": lg.log_page(rows, 50, from_head=False),
    }
    parts = [p.select(F.lit(name).alias("page"), "timestamp", "event_id") for name, p in pages.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "retention_filter",
    "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 168 HOURS",
)
def retention_filter(spark, d):
    from lumenloom.queries.base import table

    events = table(spark, d, "events")
    kept = lg.retain(events, "ts", 168, F.lit("2024-01-31").cast("timestamp_ntz"))
    return kept.select("event_id", "user_id")


# ── metrics ──────────────────────────────────────────────────────────────────────

START, END = START_MS // 1000, END_MS // 1000


def _statistics(period: int, where: str) -> str:
    return f"""
SELECT (ts // {period}) * {period} AS period_start, sum(sample_count) AS sample_count,
       CAST(sum(CAST(sum AS DECIMAL(28,10))) AS DOUBLE) AS sum,
       CASE WHEN sum(sample_count) > 0 THEN CAST(sum(CAST(sum AS DECIMAL(28,10))) AS DOUBLE) / sum(sample_count) ELSE 0 END AS average,
       min(minimum) AS minimum, max(maximum) AS maximum,
       coalesce(min_by(unit, ts) FILTER (WHERE trim(unit) <> ''), 'None') AS unit
FROM ({METRICS}) WHERE {where} GROUP BY 1"""


def _exact(df, *columns):
    """Six places for columns that depend on a division."""
    return df.withColumns({c: F.round(F.col(c).cast("decimal(38,10)"), 6).cast("double") for c in columns})


def _exact_sql(sql: str, *columns: str) -> str:
    changed = ", ".join(f"CAST(round(CAST({c} AS DECIMAL(38,10)), 6) AS DOUBLE) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({changed}) FROM ({sql})"


@query(
    "metric_statistics",
    _exact_sql(
        _statistics(3600, f"metric = 'purchase' AND dimensions = 'shard=1' AND ts BETWEEN {START} AND {END}"),
        "sum",
        "average",
    ),
)
def metric_statistics(spark, d):
    stats = mt.metric_statistics(
        metrics(spark, d), "app", "purchase", 3600, {"shard": "1"}, START, END
    )
    return _exact(stats, "sum", "average")


_DATA = [
    mt.MetricQuery("a", "app", "purchase", "Average", 86400, {"shard": "0"}),
    mt.MetricQuery("b", "app", "purchase", "Maximum", 86400, {"shard": "0"}, label="largest"),
    mt.MetricQuery("c", "app", "error", "SampleCount", 3600, {"shard": "2"}, unit="Count"),
    mt.MetricQuery("d", "app", "view", "p99", 86400, {"shard": "3"}),
    mt.MetricQuery("hidden", "app", "view", "Sum", 60, {"shard": "3"}, return_data=False),
]


def _data_sql(q: mt.MetricQuery, column: str) -> str:
    dims = ",".join(f"{k}={v}" for k, v in q.dimensions.items())
    unit = f" AND unit = '{q.unit}'" if q.unit else ""
    stats = _statistics(q.period, f"metric = '{q.metric}' AND dimensions = '{dims}'{unit}")
    return f"SELECT '{q.id}' AS id, '{q.label or q.metric}' AS label, period_start, {column} AS value FROM ({stats})"


@query(
    "metric_data",
    _exact_sql(
        " UNION ALL ".join(
            _data_sql(q, c) for q, c in zip(_DATA, ["average", "maximum", "sample_count", "maximum"])
        ),
        "value",
    ),
)
def metric_data(spark, d):
    return _exact(mt.metric_data(metrics(spark, d), _DATA), "value")


@query(
    "metric_identities",
    f"SELECT DISTINCT namespace, metric, dimensions FROM ({METRICS}) WHERE dimensions = 'shard=1'",
)
def metric_identities(spark, d):
    return mt.list_metrics(metrics(spark, d), "app", dimensions={"shard": "1"})
