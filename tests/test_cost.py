from __future__ import annotations

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lumenloom.functions import timebuckets as tb
from lumenloom.operators import cost as c

LINE = (
    "period_start timestamp, period_end timestamp, service string, region string, usage_type string, operation string,"
    " record_type string, account string, resource string, tags map<string,string>, quantity double, usage_unit string"
)
RATE = "service string, region string, usage_type string, rate double"


def t(text):
    return datetime.fromisoformat(text)


def line(start, end, quantity, record="Usage", service="AmazonEC2", tags=None, usage="BoxUsage", region="us-east-1", unit="Hrs"):
    return (t(start), t(end), service, region, usage, "Run", record, "000000000000", "i-1", tags, quantity, unit)


@pytest.fixture(scope="module")
def rates(spark):
    data = [
        ("AmazonEC2", "us-east-1", "BoxUsage", 0.0104),
        ("AmazonEC2", "us-east-1", "BoxUsage", 0.01),
        ("AmazonS3", "us-east-1", "BoxUsage", -1.0),
    ]
    return spark.createDataFrame(data, RATE)


def buckets(spark, start, end, granularity):
    out = c.bucket_list(spark, start, end, granularity).orderBy("bucket_start").collect()
    return [(r.bucket_start, r.bucket_end) for r in out]


def test_buckets_align_outwards(spark):
    daily = buckets(spark, "2024-01-01", "2024-01-03T12:00:00", "DAILY")
    assert len(daily) == 3 and daily[-1] == (t("2024-01-03"), t("2024-01-04"))
    assert len(buckets(spark, "2024-01-01T00:30:00", "2024-01-01T03:45:00", "HOURLY")) == 4
    monthly = buckets(spark, "2024-01-15", "2024-03-10", "MONTHLY")
    assert [b[0].month for b in monthly] == [1, 2, 3]
    assert len(buckets(spark, "2024-01-01", "2024-02-01", "MONTHLY")) == 1
    for start, end in [("2024-01-01", "2024-01-01"), ("2024-01-02", "2024-01-01")]:
        with pytest.raises(ValueError):
            c.bucket_list(spark, start, end, "DAILY")
    with pytest.raises(ValueError):
        c.bucket_list(spark, "2024-01-01", "2024-01-02", "WEEKLY")


def test_times_are_read_in_three_forms(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024-01-02T03:00:00+02:00",), ("2024-01-02T01:00:00",), ("x",)], "s string")
    got = [r.p for r in df.select(tb.parse_time(F.col("s")).alias("p")).collect()]
    assert got == [t("2024-01-02"), t("2024-01-02T01:00:00"), t("2024-01-02T01:00:00"), None]


def test_pricing(spark, rates):
    lines = spark.createDataFrame(
        [
            line("2024-01-01", "2024-01-02", 24.0),
            line("2024-01-01", "2024-01-02", 5.0, service="AmazonS3"),
            line("2024-01-01", "2024-01-02", -3.0, record="Credit"),
            line("2024-01-01", "2024-01-02", 2.0, record="Tax", service="none"),
        ],
        LINE,
    )
    got = sorted(r.cost for r in c.price_usage(lines, rates).collect())
    assert got == pytest.approx([-3.0, 0.0, 24 * 0.0104, 2.0][0:1] + [0.0, 24 * 0.0104, 2.0])


def test_lines_are_shared_by_seconds(spark):
    lines = spark.createDataFrame(
        [
            line("2024-01-30T12:00:00", "2024-02-01T12:00:00", 48.0),
            line("2024-02-01", "2024-02-01", 7.0),  # no length, on an edge: in no bucket
            line("2024-02-01T01:00:00", "2024-02-01T01:00:00", 7.0),  # no length, inside
        ],
        LINE,
    )
    got = sorted((r.bucket_start.day, r.quantity) for r in c.to_buckets(lines, "2024-01-01", "2024-03-01", "DAILY").collect())
    assert got == [(1, 0.0), (1, 12.0), (30, 12.0), (31, 24.0)]
    months = c.to_buckets(lines.limit(1), "2024-01-01", "2024-03-01", "MONTHLY").collect()
    assert sorted(r.quantity for r in months) == [12.0, 36.0]
    # the window cuts at whole buckets
    assert c.to_buckets(lines, "2024-01-31T05:00:00", "2024-01-31T06:00:00", "DAILY").first().quantity == 24.0


def test_cost_and_usage(spark, rates):
    lines = spark.createDataFrame(
        [
            line("2024-01-01", "2024-01-02", 24.0, tags={"team": "a"}),
            line("2024-01-01", "2024-01-02", 1.0, tags={}),
            line("2024-03-01", "2024-03-02", 1.0, record="Refund", unit="USD"),
        ],
        LINE,
    )
    out = c.cost_and_usage(
        lines, rates, "2024-01-01", "2024-04-01", "MONTHLY", ["UnblendedCost", "UsageQuantity"], [("TAG", "team")]
    )
    got = {(r.bucket_start.month, tuple(r["keys"]) if not r.is_total else None, r.metric): (r.amount, r.unit) for r in out.collect()}
    assert got[1, None, "UnblendedCost"] == ("0.2600000000", "USD")
    assert got[1, ("a",), "UsageQuantity"] == ("24.0000000000", "Hrs")
    assert got[1, ("",), "UnblendedCost"] == ("0.0104000000", "USD")
    assert got[2, None, None] == (None, None)
    assert got[3, None, "UnblendedCost"] == ("1.0000000000", "USD")
    assert got[3, None, "UsageQuantity"][0] == "0.0000000000"
    with pytest.raises(ValueError):
        c.cost_and_usage(lines, rates, "2024-01-01", "2024-04-01", "MONTHLY", [])


@pytest.mark.parametrize("granularity", ["HOURLY", "DAILY", "MONTHLY"])
def test_running_sums_give_what_every_bucket_gets(spark, granularity):
    """Lines from a second to a year against the lines spread over their buckets one by one."""
    r = random.Random(granularity)
    lines = []
    for i in range(60):
        start = 1_704_067_200 + r.randrange(-40 * 86400, 60 * 86400)
        size = r.choice([0, 1, 1800, 3600, 90_000, 40 * 86400, 366 * 86400])
        lines.append((f"s{i % 3}" if i % 7 else None, start, start + size, r.randrange(1, 1000) / 8))
    df = spark.createDataFrame(lines, "service string, a long, b long, quantity double")
    df = df.select("service", F.timestamp_seconds("a").alias("period_start"), F.timestamp_seconds("b").alias("period_end"), "quantity")
    window = ("2024-01-01", "2024-02-10")
    got = c.bucket_totals(df, *window, granularity, [F.col("service")], {"q": F.col("quantity")})
    one_by_one = c.to_buckets(df, *window, granularity).groupBy("service", "bucket_start").agg(F.sum("quantity").alias("q"))
    want = {(x.service, x.bucket_start): x.q for x in one_by_one.collect()}
    have = {(x.service, x.bucket_start): float(x.q) for x in got.collect()}
    assert have.keys() == want.keys()
    assert all(have[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_long_lines_do_not_multiply(spark):
    """A hundred lines of a year by the hour: three rows each, and one per bucket and key in the end."""
    df = spark.range(100).select(F.lit("s").alias("service"), F.lit("2024-01-01").cast("timestamp").alias("period_start"), F.lit("2025-01-01").cast("timestamp").alias("period_end"), F.lit(8784.0).alias("quantity"))
    out = c.bucket_totals(df, None, None, "HOURLY", [F.col("service")], {"q": F.col("quantity")})
    rows = out.collect()
    assert len(rows) == 8784 and {float(r.q) for r in rows} == {100.0}


def test_ungrouped_costs_have_only_totals(spark, rates):
    lines = spark.createDataFrame([line("2024-01-01", "2024-01-02", 10.0)], LINE)
    out = c.cost_and_usage(lines, rates, "2024-01-01", "2024-02-01", "MONTHLY", ["BlendedCost"]).collect()
    assert [(r.is_total, r["keys"], r.amount) for r in out] == [(True, [], "0.1040000000")]


def test_credit_is_capped_by_the_month(spark, rates):
    lines = spark.createDataFrame(
        [line("2024-01-31", "2024-02-02", 20000.0), line("2024-02-01", "2024-02-02", 5.0, record="Tax")], LINE
    )
    priced = c.price_usage(lines, rates)
    credits = {r.period_start.month: r for r in c.apply_credit(priced, 104.5).collect()}
    assert credits[1].quantity == pytest.approx(-104.0)
    assert credits[2].cost == pytest.approx(-104.0)
    assert credits[1].period_end == t("2024-02-01") and credits[1].service == "Credits"
    capped = c.apply_credit(priced, 50.0)
    assert {r.quantity for r in capped.collect()} == {-50.0}
    both = c.with_credits(priced, capped, {"Dimensions": {"Key": "RECORD_TYPE", "Values": ["Usage"]}})
    assert both.count() == 2
    out = c.cost_and_usage(lines, rates, "2024-01-01", "2024-03-01", "MONTHLY", ["UnblendedCost"], monthly_credit=1000.0)
    assert {r.bucket_start.month: r.amount for r in out.collect()} == {1: "0.0000000000", 2: "5.0000000000"}


@pytest.mark.parametrize(
    ("expression", "n"),
    [
        (None, 3),
        ({"Dimensions": {"Key": "SERVICE", "Values": ["AmazonS3"]}}, 1),
        ({"Dimensions": {"Key": "SERVICE", "Values": ["amazons3"]}}, 0),
        ({"Dimensions": {"Key": "SERVICE", "Values": ["amazons3"], "MatchOptions": ["CASE_INSENSITIVE"]}}, 1),
        ({"Dimensions": {"Key": "UNKNOWN", "Values": []}}, 0),
        ({"Tags": {"Key": "team", "Values": []}}, 1),
        ({"Not": {"Tags": {"Key": "team", "Values": ["a"]}}}, 2),
        ({"And": [{"Tags": {"Key": "team", "Values": ["a"]}}, {"Dimensions": {"Key": "REGION", "Values": ["us-east-1"]}}]}, 1),
        ({"Or": [{"Tags": {"Key": "team", "Values": ["a"]}}, {"Dimensions": {"Key": "SERVICE", "Values": ["AmazonS3"]}}]}, 2),
        ({"CostCategories": {"Key": "k", "Values": ["v"]}}, 0),
        ({"And": []}, 3),
    ],
)
def test_cost_filters(spark, expression, n):
    lines = spark.createDataFrame(
        [
            line("2024-01-01", "2024-01-02", 1.0, tags={"team": "a"}),
            line("2024-01-01", "2024-01-02", 1.0, service="AmazonS3", tags=None),
            line("2024-01-01", "2024-01-02", 1.0, service="x", tags={}),
        ],
        LINE,
    )
    assert c.cost_where(lines, expression).count() == n


def test_focus_rows(spark, rates):
    lines = spark.createDataFrame(
        [line("2024-02-10", "2024-02-11", 24.0), line("2024-02-10", "2024-02-11", 9.0, record="SavingsPlanUpfrontFee", service="Odd")],
        LINE,
    )
    first, second = c.to_focus(lines, rates).orderBy("ServiceName").collect()
    assert len(first) == 27
    assert (first.BillingPeriodStart, first.BillingPeriodEnd) == ("2024-02-01T00:00:00Z", "2024-03-01T00:00:00Z")
    assert first.BilledCost == pytest.approx(0.2496) and first.ResourceType == "Instance" and first.ServiceCategory == "Compute"
    assert (second.ServiceCategory, second.ResourceType, second.ChargeCategory, second.BilledCost) == ("Other", "Odd", "Adjustment", 9.0)
    assert first.Tags == {}


def test_usage_report_replaces_only_its_month(spark, rates, tmp_path):
    path = str(tmp_path / "report")
    lines = spark.createDataFrame([line("2024-01-05", "2024-01-06", 1.0), line("2024-02-05", "2024-02-06", 2.0)], LINE)
    for month in ("2024-01", "2024-02", "2024-01"):
        c.write_usage_report(lines, rates, path, month)
    got = spark.read.parquet(path).collect()
    assert sorted((str(r.billing_month), r.UsageQuantity) for r in got) == [("2024-01", 1.0), ("2024-02", 2.0)]


def test_storage_usage(spark):
    objects = spark.createDataFrame(
        [("b", None, 2**30), ("b", None, 2**30), ("empty", None, 0), ("far", "eu", 5), ("neg", None, -5)],
        "bucket string, bucket_region string, size long",
    ).withColumn("tags", F.lit(None).cast("map<string,string>"))
    got = {r.resource: r.quantity for r in c.storage_usage(objects, "2024-01-01", "2024-01-31", "us-east-1").collect()}
    assert got == {None: 0.0, "arn:aws:s3:::b": 2.0}


def test_dimension_and_tag_values(spark, rows):
    lines = spark.createDataFrame(
        [
            line("2024-01-01", "2024-01-02", 1.0, tags={"team": "a", "env": "x"}),
            line("2024-01-01", "2024-01-02", 1.0, service="", tags=None),
            line("2024-01-01", "2024-01-02", 1.0, tags={"team": "b"}),
        ],
        LINE,
    )
    assert rows(c.dimension_values(lines, "SERVICE")) == [("AmazonEC2",)]
    assert rows(c.dimension_values(lines, "SERVICE", "S3")) == []
    assert rows(c.tag_values(lines)) == [("env",), ("team",)]
    assert rows(c.tag_values(lines, "team")) == [("a",), ("b",)]
    assert rows(c.tag_values(lines, "team", "b")) == [("b",)]


def test_rates_come_from_offers(spark, rows):
    def offer(attributes, *prices):
        dims = {f"d{i}": {"pricePerUnit": {"USD": p}} for i, p in enumerate(prices)}
        return json.dumps({"product": {"attributes": attributes}, "terms": {"OnDemand": {"t": {"priceDimensions": dims}}}})

    data = [
        ("AmazonEC2", offer({"regionCode": "r", "usagetype": "BoxUsage:a"}, "0", "0.5", "0.7")),
        ("AmazonEC2", offer({"regionCode": "r", "instanceType": "b"}, "2")),
        ("AWSLambda", offer({"regionCode": "r"}, "x", "3e-1")),
        ("AmazonSNS", offer({"regionCode": "r"}, "4")),
        ("AmazonS3", offer({"regionCode": "r", "usagetype": "none"}, "0")),
        ("AmazonS3", '{"product":{"attributes":{"regionCode":"r"}}}'),
        ("AmazonS3", "no json"),
    ]
    df = spark.createDataFrame(data, "service string, offer string")
    assert rows(c.rates_from_offers(df)) == [
        ("AWSLambda", "r", "AWS-Lambda-Requests", 0.3),
        ("AmazonEC2", "r", "BoxUsage:a", 0.5),
        ("AmazonEC2", "r", "BoxUsage:b", 2.0),
    ]


def test_windows_compare_instants(spark):
    from lumenloom.operators import cost

    # four hours, although the text of the end sorts before that of the start
    assert cost.bucket_list(spark, "2024-01-01T05:00:00+09:00", "2024-01-01T00:00:00Z", "HOURLY").count() == 4
    with pytest.raises(ValueError):
        cost.bucket_list(spark, "2024-01-01T00:00:00Z", "2024-01-01T05:00:00+09:00", "HOURLY")
    with pytest.raises(ValueError):
        cost.bucket_list(spark, "soon", "2024-01-01", "DAILY")
