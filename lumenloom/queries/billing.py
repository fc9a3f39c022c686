"""Cost and usage over lines derived from lineitem, with rates derived from part."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenloom.operators import cost as c
from lumenloom.queries.base import PRICED, RATES, USAGE, rates, table, usage
from lumenloom.queries.registry import query
from lumenloom.session import shared_dir

START, END = "1995-01-01", "2002-01-01"


def _six(sql: str, name: str) -> str:
    return f"CAST(round(CAST({sql} AS DECIMAL(38,10)), 6) AS DOUBLE) AS {name}"


def _rounded(df, *columns):
    return df.withColumns({x: F.round(F.col(x).cast("decimal(38,10)"), 6).cast("double") for x in columns})


@query(
    "usage_rate_join",
    f"SELECT service, region, usage_type, record_type, resource, quantity, {_six('cost', 'cost')} FROM ({PRICED})",
)
def usage_rate_join(spark, d):
    priced = c.price_usage(usage(spark, d), rates(spark, d))
    return _rounded(
        priced.select("service", "region", "usage_type", "record_type", "resource", "quantity", "cost"), "cost"
    )


@query(
    "price_list_rates",
    f"SELECT service, region, usage_type, {_six('max(rate)', 'rate')} FROM ({RATES}) WHERE rate > 0 GROUP BY 1, 2, 3",
)
def price_list_rates(spark, d):
    """Rates read from price-list offers, here made from the rate rows."""
    name = F.struct(F.col("region").alias("regionCode"), F.col("usage_type").alias("usagetype"))
    usd = F.struct(F.col("rate").cast("string").alias("USD"))
    dims = F.create_map(F.lit("dim"), F.struct(usd.alias("pricePerUnit")))
    terms = F.create_map(F.lit("term"), F.struct(dims.alias("priceDimensions")))
    offer = F.struct(F.struct(name.alias("attributes")).alias("product"), F.struct(terms.alias("OnDemand")).alias("terms"))
    found = c.rates_from_offers(rates(spark, d).select("service", F.to_json(offer).alias("offer")))
    return _rounded(found.groupBy("service", "region", "usage_type").agg(F.max("rate").alias("rate")), "rate")


def _buckets(unit: str) -> str:
    return (
        f"SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}' - INTERVAL 1 {unit},"
        f" INTERVAL 1 {unit})) AS bucket_start"
    )


def _bucketed(unit: str, source: str) -> str:
    """Lines by bucket as a plain range join, independent of how the operator does it."""
    return f"""
SELECT l.*, b.bucket_start, b.bucket_start + INTERVAL 1 {unit} AS bucket_end,
       greatest(0, date_diff('second', greatest(period_start, b.bucket_start),
                             least(period_end, b.bucket_start + INTERVAL 1 {unit})))
       / greatest(1, date_diff('second', period_start, period_end)) AS share
FROM ({source}) l JOIN ({_buckets(unit)}) b
  ON period_start < b.bucket_start + INTERVAL 1 {unit} AND period_end > b.bucket_start"""


@query(
    "interval_bucket_join",
    f"SELECT resource, region, period_start, bucket_start, bucket_end, {_six('quantity * share', 'quantity')}"
    f" FROM ({_bucketed('DAY', USAGE)})",
)
def interval_bucket_join(spark, d):
    lines = c.to_buckets(usage(spark, d), START, END, "DAILY")
    return _rounded(
        lines.select("resource", "region", "period_start", "bucket_start", "bucket_end", "quantity"), "quantity"
    )


_METRICS = ["UnblendedCost", "UsageQuantity"]


def _amount(sql: str) -> str:
    return f"CAST(CAST(sum(CAST({sql} AS DECIMAL(28,12))) AS DECIMAL(38,10)) AS VARCHAR)"


def _cost_sql(source: str, keys: str, names: str) -> str:
    lines = _bucketed("MONTH", source)
    usd = "record_type IN ('Credit', 'Refund', 'Tax')"
    return f"""
WITH lines AS (SELECT *, cost * share AS c, CASE WHEN {usd} THEN 0 ELSE quantity * share END AS q,
                      {keys} FROM ({lines})),
     summed AS (SELECT bucket_start, {names}, grouping(key0) AS total, {_amount('c')} AS cost, {_amount('q')} AS quantity
                FROM lines GROUP BY GROUPING SETS ((bucket_start), (bucket_start, {names})))
SELECT b.bucket_start, total = 1 AS is_total,
       CASE WHEN total = 1 THEN '' ELSE concat_ws('|', {names}) END AS keys,
       m.metric, CAST(round(CAST(CASE m.metric WHEN 'UnblendedCost' THEN cost ELSE quantity END AS DECIMAL(38,10)), 6) AS DOUBLE) AS amount,
       CASE m.metric WHEN 'UnblendedCost' THEN 'USD' ELSE 'Hrs' END AS unit
FROM ({_buckets('MONTH')}) b JOIN summed s USING (bucket_start)
CROSS JOIN (SELECT unnest(['UnblendedCost', 'UsageQuantity']) AS metric) m"""


def _flat(df):
    flat = df.select("bucket_start", "is_total", F.array_join("keys", "|").alias("keys"), "metric", "amount", "unit")
    # to six places: lines are spread in another order than SQL does it
    return _rounded(flat.where("metric IS NOT NULL"), "amount")


@query(
    "cost_and_usage",
    _cost_sql(PRICED, "service AS key0, coalesce(tags, '') AS key1", "key0, key1"),
)
def cost_and_usage(spark, d):
    out = c.cost_and_usage(
        usage(spark, d), rates(spark, d), START, END, "MONTHLY", _METRICS, [("DIMENSION", "SERVICE"), ("TAG", "team")]
    )
    return _flat(out)


_EMPTY_END = "2003-01-01"


@query(
    "cost_empty_buckets",
    f"SELECT b.bucket_start, b.bucket_start + INTERVAL 1 MONTH AS bucket_end FROM (SELECT unnest(generate_series("
    f"TIMESTAMP '{START}', TIMESTAMP '{_EMPTY_END}' - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS bucket_start) b"
    f" WHERE NOT EXISTS (SELECT 1 FROM ({USAGE}) WHERE period_start < b.bucket_start + INTERVAL 1 MONTH AND period_end > b.bucket_start)",
)
def cost_empty_buckets(spark, d):
    """Buckets no line falls into still appear."""
    out = c.cost_and_usage(usage(spark, d), rates(spark, d), START, _EMPTY_END, "MONTHLY", ["UnblendedCost"])
    return out.where("metric IS NULL").select("bucket_start", "bucket_end")


_MONTHS = f"SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 1 MONTH)) AS month"
CREDIT_LIMIT = 500.0

CREDITS = f"""
SELECT region, month, -least({CREDIT_LIMIT}, spent) AS credit, account FROM (
    SELECT region, month, max(account) AS account,
           CAST(sum(CAST(cost * date_diff('second', greatest(period_start, month), least(period_end, month + INTERVAL 1 MONTH))
               / greatest(1, date_diff('second', period_start, period_end)) AS DECIMAL(28,12))) AS DOUBLE) AS spent
    FROM ({PRICED}) JOIN ({_MONTHS}) ON period_start < month + INTERVAL 1 MONTH AND period_end > month
    WHERE record_type = 'Usage' AND cost <> 0 AND period_start < period_end GROUP BY 1, 2)
WHERE spent > 0"""


@query(
    "credit_allocation",
    f"SELECT region, month AS period_start, month + INTERVAL 1 MONTH AS period_end, account, {_six('credit', 'cost')},"
    f" 'Credits' AS service, 'Credit' AS record_type FROM ({CREDITS})",
)
def credit_allocation(spark, d):
    priced = c.price_usage(usage(spark, d), rates(spark, d))
    credits = c.apply_credit(priced, CREDIT_LIMIT)
    return _rounded(
        credits.select("region", "period_start", "period_end", "account", "cost", "service", "record_type"), "cost"
    )


@query(
    "credit_union",
    f"SELECT service, region, record_type, count(*) AS lines, {_six('sum(CAST(cost AS DECIMAL(28,10)))', 'cost')} FROM ("
    f" SELECT service, region, record_type, cost FROM ({PRICED}) WHERE region <> 'sa-east-1'"
    f" UNION ALL SELECT 'Credits', region, 'Credit', credit FROM ({CREDITS}) WHERE region <> 'sa-east-1') GROUP BY 1, 2, 3",
)
def credit_union(spark, d):
    expression = {"Not": {"Dimensions": {"Key": "REGION", "Values": ["sa-east-1"]}}}
    priced = c.price_usage(c.cost_where(usage(spark, d), expression), rates(spark, d))
    both = c.with_credits(priced, c.apply_credit(priced, CREDIT_LIMIT), expression)
    total = F.sum(F.col("cost").cast("decimal(28,10)")).cast("double")
    return _rounded(
        both.groupBy("service", "region", "record_type").agg(F.count("*").alias("lines"), total.alias("cost")), "cost"
    )


_FILTER = {
    "And": [
        {"Dimensions": {"Key": "SERVICE", "Values": ["amazons3", "AMAZONEC2"], "MatchOptions": ["CASE_INSENSITIVE"]}},
        {"Or": [{"Tags": {"Key": "team", "Values": ["A"]}}, {"Not": {"Tags": {"Key": "env", "Values": []}}}]},
        {"Not": {"CostCategories": {"Key": "any", "Values": ["x"]}}},
    ]
}


@query(
    "cost_filter",
    f"SELECT service, resource, period_start, quantity FROM ({USAGE}) WHERE service IN ('AmazonS3', 'AmazonEC2')"
    " AND (tags = 'A' OR env IS NULL)",
)
def cost_filter(spark, d):
    return c.cost_where(usage(spark, d), _FILTER).select("service", "resource", "period_start", "quantity")


@query(
    "dimension_values",
    f"SELECT DISTINCT resource AS value FROM ({USAGE}) WHERE contains(resource, '-1') AND region = 'eu-west-1'",
)
def dimension_values(spark, d):
    expression = {"Dimensions": {"Key": "REGION", "Values": ["eu-west-1"]}}
    return c.dimension_values(usage(spark, d), "RESOURCE_ID", "-1", expression)


@query(
    "tag_values",
    f"SELECT 'key' AS kind, unnest(['team', 'env']) AS value UNION ALL SELECT DISTINCT 'value', tags FROM ({USAGE}) WHERE tags IS NOT NULL",
)
def tag_values(spark, d):
    lines = usage(spark, d)
    keys = c.tag_values(lines).select(F.lit("key").alias("kind"), "value")
    return keys.unionByName(c.tag_values(lines, "team").select(F.lit("value").alias("kind"), "value"))


_CATEGORY = (
    "CASE service WHEN 'AmazonEC2' THEN 'Compute' WHEN 'AWSLambda' THEN 'Compute' WHEN 'AmazonS3' THEN 'Storage'"
    " WHEN 'AmazonRDS' THEN 'Databases' ELSE 'Other' END"
)
_TYPE = (
    "CASE service WHEN 'AmazonEC2' THEN 'Instance' WHEN 'AWSLambda' THEN 'Function' WHEN 'AmazonS3' THEN 'Bucket'"
    " WHEN 'AmazonRDS' THEN 'DBInstance' ELSE service END"
)
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"

FOCUS = f"""
SELECT {_ISO.format("date_trunc('month', period_start)")} AS BillingPeriodStart,
       {_ISO.format("date_trunc('month', period_start) + INTERVAL 1 MONTH")} AS BillingPeriodEnd,
       {_ISO.format('period_start')} AS ChargePeriodStart, {_ISO.format('period_end')} AS ChargePeriodEnd,
       account AS BillingAccountId, account AS SubAccountId, {_CATEGORY} AS ServiceCategory,
       service AS ServiceName, region AS Region, resource AS ResourceId, resource AS ResourceName,
       {_TYPE} AS ResourceType, CASE record_type WHEN 'Tax' THEN 'Tax' WHEN 'Refund' THEN 'Refund' ELSE 'Usage' END AS ChargeCategory,
       'Standard' AS ChargeClass, 'Synthesized usage line' AS ChargeDescription, 'Usage-Based' AS ChargeFrequency,
       usage_type AS ChargeSubcategory, quantity AS PricingQuantity, usage_unit AS PricingUnit,
       quantity AS UsageQuantity, usage_unit AS UsageUnit, {_six('cost', 'BilledCost')}, {_six('cost', 'EffectiveCost')},
       {_six('cost', 'ListCost')}, {_six('cost', 'ContractedCost')}, 'USD' AS BillingCurrency,
       CASE WHEN tags IS NULL THEN '{{}}' ELSE concat('{{"team":"', tags, '","env":"', env, '"}}') END AS Tags
FROM ({PRICED})"""

_COSTS = ["BilledCost", "EffectiveCost", "ListCost", "ContractedCost"]


@query("focus_projection", FOCUS)
def focus_projection(spark, d):
    rows = c.to_focus(usage(spark, d), rates(spark, d))
    return _rounded(rows.withColumn("Tags", F.to_json("Tags")), *_COSTS)


@query(
    "usage_report_parquet",
    f"SELECT ServiceName, ChargeCategory, count(*) AS lines, {_six('sum(CAST(BilledCost AS DECIMAL(28,10)))', 'cost')}"
    f" FROM ({FOCUS}) WHERE BillingPeriodStart = '1998-05-01T00:00:00Z' GROUP BY 1, 2",
)
def usage_report_parquet(spark, d):
    path = shared_dir(spark, "usage-report")
    c.write_usage_report(usage(spark, d), rates(spark, d), path, "1998-05")
    total = F.sum(F.col("BilledCost").cast("decimal(28,10)")).cast("double")
    report = spark.read.parquet(path)
    return _rounded(
        report.groupBy("ServiceName", "ChargeCategory").agg(F.count("*").alias("lines"), total.alias("cost")), "cost"
    )


@query(
    "storage_usage",
    f"SELECT concat('arn:aws:s3:::', source) AS resource, {_six('sum(n_chars) / 1073741824.0 * (7 * 86400 / 2592000.0) * 1e6', 'quantity')},"
    " 'GB-Mo' AS usage_unit FROM documents WHERE lang <> 'en' GROUP BY source HAVING sum(n_chars) > 0"
    " UNION ALL SELECT NULL, 0.0, 'GB-Mo'",
)
def storage_usage(spark, d):
    objects = table(spark, d, "documents").select(
        F.col("source").alias("bucket"),
        F.when(F.col("lang") == "en", "eu-west-1").alias("bucket_region"),
        F.lit(None).cast("map<string,string>").alias("tags"),
        F.col("n_chars").alias("size"),
    )
    lines = c.storage_usage(objects, "2024-01-01", "2024-01-08", "us-east-1")
    # the texts are small, so the quantity is shown in millionths
    return _rounded(lines.select("resource", (F.col("quantity") * 1e6).alias("quantity"), "usage_unit"), "quantity")
