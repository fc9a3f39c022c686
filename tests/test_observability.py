from __future__ import annotations

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lumenloom.operators import logs as lg
from lumenloom.operators import metrics as mt

SCHEMA = (
    "log_group string, log_stream string, timestamp long, message string, ingestion_time long, sequence long, event_id string"
)


def event(ts, seq, body, group="g", stream="s", ingested=0):
    text = body if isinstance(body, str) else json.dumps(body)
    return (group, stream, ts, text, ingested, seq, f"e{seq}")


@pytest.fixture(scope="module")
def logs(spark):
    data = [
        event(1000, 1, {"level": "INFO", "n": 9, "params": {"job_id": "a|b=c"}}),
        event(1000, 2, {"level": "ERROR", "n": 10, "params": {"job_id": "j2"}}),
        event(2000, 3, {"level": "INFO", "n": 100}, ingested=5),
        event(3000, 4, "plain text", ingested=4),
        event(4000, 5, {"level": None, "n": 9}, group="h"),
        event(5000, 6, {"level": "INFO", "obj": {"x": [1, 2]}}, group="h"),
    ]
    return spark.createDataFrame(data, SCHEMA)


def ids(query):
    return [r["@ptr"] for r in query.run().collect()]


def test_groups_count_once_and_must_be_named(logs):
    assert ids(lg.log_query(logs, ["g", "g", " "])) == ["e1", "e2", "e3", "e4"]
    with pytest.raises(ValueError):
        lg.log_query(logs, ["", " "])


def test_time_range_is_inclusive(logs):
    assert ids(lg.log_query(logs, ["g"], 1000, 2000)) == ["e1", "e2", "e3"]


def test_filters(logs):
    q = lg.log_query(logs, ["g", "h"])
    assert ids(q.where_eq("params.job_id", "a|b=c")) == ["e1"]
    assert ids(q.where_ne("level", "INFO")) == ["e2", "e4", "e5"]
    assert ids(q.where_eq("n", "9").where_eq("level", "INFO")) == ["e1"]


def test_same_millisecond_ties_turn_with_the_sort(logs):
    q = lg.log_query(logs, ["g"])
    assert ids(q.sort("@timestamp")) == ["e1", "e2", "e3", "e4"]
    assert ids(q.sort("@timestamp", desc=True)) == ["e4", "e3", "e2", "e1"]
    assert ids(q.sort("@ingestionTime", desc=True)) == ["e3", "e4", "e2", "e1"]


def test_other_fields_sort_as_text_and_the_last_sort_wins(logs):
    q = lg.log_query(logs, ["g"]).sort("@timestamp").sort("n", desc=True)
    assert ids(q) == ["e1", "e3", "e2", "e4"]


def test_dedup_keeps_the_newest_without_a_sort(logs):
    q = lg.log_query(logs, ["g", "h"]).dedup("level")
    # missing, null and unparsable fields are one tuple
    assert ids(q) == ["e6", "e5", "e2"]
    assert ids(q.sort("@timestamp")) == ["e1", "e2", "e4"]
    assert ids(lg.log_query(logs, ["g"]).dedup("level").sort("n", desc=True)) == ["e1", "e2", "e4"]


def test_dedup_comes_before_the_limit(logs):
    assert ids(lg.log_query(logs, ["g", "h"]).limit(2).dedup("level")) == ["e6", "e5"]


def test_fields(logs):
    row = lg.log_query(logs, ["h"]).fields("@timestamp", "obj", "level", "missing").run().collect()[1]
    assert row.asDict() == {
        "@timestamp": "1970-01-01 00:00:05.000", "obj": '{"x":[1,2]}', "level": "INFO", "missing": "", "@ptr": "e6",
    }
    assert lg.log_query(logs, ["h"]).run().columns == ["@timestamp", "@message", "@ptr"]


def test_counters(logs):
    q = lg.log_query(logs, ["g"]).where_eq("level", "INFO")
    assert tuple(lg.query_counters(q).first()) == (4, 2)
    seen = Observation("scan")
    q.observe(seen).run().collect()
    assert seen.get["records_scanned"] == 4


def test_filter_logs_and_pages(logs):
    assert [r.event_id for r in lg.filter_logs(logs, "g", contains="ERR").collect()] == ["e2"]
    assert [r.event_id for r in lg.filter_logs(logs, "g", ["s"], 1000, 2000, limit=2).collect()] == ["e1", "e2"]
    g = logs.where("log_group = 'g'")
    page = lambda **kw: [r.event_id for r in lg.log_page(g, 2, **kw).collect()]
    assert page() == ["e1", "e2"]
    assert page(from_head=False) == ["e3", "e4"]
    assert page(after=(1000, 1, "e1")) == ["e2", "e3"]
    assert page(before=(2000, 3, "e3")) == ["e1", "e2"]


def test_stream_stats_count_bytes(spark):
    df = spark.createDataFrame([event(5, 1, "é", ingested=9), event(2, 2, "", ingested=3)], SCHEMA)
    row = lg.log_stream_stats(df).first()
    assert (row.first_event, row.last_event, row.last_ingestion, row.stored_bytes) == (2, 5, 9, 2 + 26 + 26)


# ── metrics ──────────────────────────────────────────────────────────────────────

METRIC = (
    "namespace string, metric string, dimensions map<string,string>, ts long, value double,"
    " sample_count double, sum double, minimum double, maximum double, unit string"
)


def datum(ts, value=None, dims=None, unit=None, stats=(0.0, 0.0, 0.0, 0.0)):
    return ("app", "m", dims, ts, value, *map(float, stats), unit)


@pytest.fixture(scope="module")
def data(spark):
    rows = [
        datum(0, 1.0, unit=" "),
        datum(59, 3.0, unit="Count"),
        datum(60, 10.0, unit="Bytes"),
        datum(61, stats=(5, 150, 20, 40)),
        datum(61, 7.0, {"B": "2", "A": "1"}),
        datum(62, 8.0, {"A": "10"}),
        datum(63, 9.0, {"AA": "1", "C": "3"}),
    ]
    return spark.createDataFrame(rows, METRIC)


def test_statistics_per_period(data):
    got = [tuple(r) for r in mt.metric_statistics(data, "app", "m", 60).collect()]
    assert got == [(0, 2.0, 4.0, 2.0, 1.0, 3.0, "Count"), (60, 6.0, 160.0, 160 / 6, 10.0, 40.0, "Bytes")]


def test_statistic_set_average(data):
    only = data.where("sample_count > 0")
    row = mt.metric_statistics(only, "app", "m", 60).first()
    assert (row.average, row.minimum, row.maximum) == (30.0, 20.0, 40.0)


def test_range_unit_and_exact_dimensions(data):
    run = lambda **kw: [(r.period_start, r.sum) for r in mt.metric_statistics(data, "app", "m", 60, **kw).collect()]
    assert run(start=59, end=60) == [(0, 3.0), (60, 10.0)]
    assert run(unit="Count") == [(0, 3.0)]
    assert run(unit="None") == run()
    assert run(dimensions={"A": "1", "B": "2"}) == [(60, 7.0)]
    assert run(dimensions={"A": "1"}) == []


def test_metric_data(data):
    queries = [
        mt.MetricQuery("a", "app", "m", "Sum"),
        mt.MetricQuery("b", "app", "m", "p90", 60, label="top"),
        mt.MetricQuery("c", "app", "m", "Sum", return_data=False),
    ]
    got = sorted(tuple(r) for r in mt.metric_data(data, queries).collect())
    assert got == [("a", "m", 0, 4.0), ("a", "m", 60, 160.0), ("b", "top", 0, 3.0), ("b", "top", 60, 40.0)]


def test_listing_needs_real_containment(data, rows):
    assert rows(mt.list_metrics(data, dimensions={"A": "1"}), "dimensions") == [("A=1,B=2",)]
    assert mt.list_metrics(data, "app", "m").count() == 4
    assert mt.list_metrics(data, "other").count() == 0


def test_periods_before_the_epoch(spark):
    got = spark.range(1).select(mt.period_start(F.lit(-1), 60).alias("p")).first().p
    assert got == -60


def test_no_search_is_cut_unless_asked(spark):
    from lumenloom.sources import positions

    rows = spark.range(20_000).selectExpr(
        "'g' AS log_group", "'s' AS log_stream", "id AS timestamp", "concat('{\"k\":', id % 7, '}') AS message",
        "id AS ingestion_time", "id AS sequence", "cast(id AS string) AS event_id",
    )
    assert lg.filter_logs(rows, "g").count() == 20_000
    assert lg.log_page(rows).count() == 20_000
    assert lg.log_query(rows, ["g"]).run().count() == 20_000
    assert lg.log_query(rows, ["g"]).limit(15_000).run().count() == 15_000
    log = rows.selectExpr("sequence AS sequence_number", "timestamp AS arrival")
    assert positions.read_from(log, "OLDEST").count() == 20_000
    assert positions.read_from(log, "OLDEST", limit=5000).count() == 5000
    assert positions.list_prefixes(rows.selectExpr("event_id AS key")).count() == 20_000


def test_sums_of_tiny_and_large_values(spark):
    from lumenloom.operators import metrics

    data = [("n", "m", {}, 10, v, None, None, None, None, u) for v, u in ((1e-12, " "), (3e-12, "Count"))]
    data += [("n", "big", {}, 10, 1e19, None, None, None, None, None)]
    kind = "namespace string, metric string, dimensions map<string,string>, ts bigint, value double, sample_count double, sum double, minimum double, maximum double, unit string"
    rows = metrics.fill_statistics(spark.createDataFrame(data, kind))
    got = {r.metric: r for r in metrics.statistics(rows, "metric").collect()}
    assert got["m"]["sum"] == pytest.approx(4e-12)
    assert got["m"].average == pytest.approx(2e-12)
    assert (got["m"].unit, got["big"]["sum"]) == ("Count", 1e19)
