"""Cost and usage.

A usage line has: period_start, period_end, service, region, usage_type, operation,
record_type, account, resource, tags (MAP), quantity, usage_unit. Periods are
half-open. Rates have: service, region, usage_type, rate (USD per unit).
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenloom.functions import json_paths as jp
from lumenloom.functions import timebuckets as tb
from lumenloom.functions.billing_maps import (
    charge_category,
    is_usd,
    resource_type,
    service_category,
)
from lumenloom.functions.booleans import every, known, some

RATE_KEYS = ["service", "region", "usage_type"]

# Dimension name -> usage column.
DIMENSIONS = {
    "SERVICE": "service",
    "SERVICE_CODE": "service",
    "REGION": "region",
    "USAGE_TYPE": "usage_type",
    "OPERATION": "operation",
    "RECORD_TYPE": "record_type",
    "LINKED_ACCOUNT": "account",
    "PAYER_ACCOUNT": "account",
    "LINKED_ACCOUNT_NAME": "account",
    "RESOURCE_ID": "resource",
}

COST_METRICS = ["UnblendedCost", "BlendedCost", "AmortizedCost", "NetUnblendedCost", "NetAmortizedCost"]
QUANTITY_METRICS = ["UsageQuantity", "NormalizedUsageAmount"]

AMOUNT = "decimal(38,12)"  # sums of decimals do not depend on their order
BYTES_PER_GB = float(1 << 30)
SECONDS_PER_MONTH = 30 * 86400.0


def dimension(name: str) -> Column:
    """The usage column of a dimension; null for an unknown one."""
    return F.col(DIMENSIONS[name]) if name in DIMENSIONS else F.lit(None).cast("string")


def price_usage(lines: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds ``cost``: quantity times rate; 0 without a rate, the quantity itself if in USD.

    Repeated rates count with their highest value. The join carries no hint: rates
    are broadcast while they are below the optimiser's size threshold.
    """
    best = rates.where("rate > 0").groupBy(*RATE_KEYS).agg(F.max("rate").alias("rate"))
    joined = lines.join(best, RATE_KEYS, "left")
    per_unit = F.col("quantity") * F.coalesce("rate", F.lit(0.0))
    cost = F.when(is_usd(F.col("record_type")), F.col("quantity")).otherwise(per_unit)
    return joined.withColumn("cost", cost).select(*lines.columns, "cost")


def rates_from_offers(offers: DataFrame, service: str = "service", offer: str = "offer") -> DataFrame:
    """Rates (service, region, usage_type, rate) from price-list offers given as JSON text.

    The rate is the first positive on-demand price in USD. An offer without a usage
    type gets one made from its attributes, where the service has a rule for it.
    """

    def attribute(v: Column, name: str) -> Column:
        return jp.at(v, ["product", "attributes", name], "string")

    def price(v: Column) -> Column:
        terms = F.map_values(jp.at(v, ["terms", "OnDemand"], "map<string,variant>"))
        dimensions = F.flatten(
            F.transform(
                terms,
                lambda t: F.coalesce(
                    F.map_values(jp.at(t, ["priceDimensions"], "map<string,variant>")),
                    F.array().cast("array<variant>"),
                ),
            )
        )
        prices = F.transform(dimensions, lambda d: jp.at(d, ["pricePerUnit", "USD"], "string").try_cast("double"))
        return F.try_element_at(F.filter(prices, lambda p: p > 0), F.lit(1))

    v, code = jp.parse(F.col(offer)), F.col(service)
    made = (
        F.when(code == "AmazonEC2", F.concat(F.lit("BoxUsage:"), F.coalesce(attribute(v, "instanceType"), F.lit(""))))
        .when(code == "AmazonS3", F.concat(F.lit("TimedStorage-"), F.coalesce(attribute(v, "volumeType"), F.lit(""))))
        .when(code == "AWSLambda", F.coalesce(attribute(v, "group"), F.lit("AWS-Lambda-Requests")))
    )
    usage_type = F.when(attribute(v, "usagetype") != "", attribute(v, "usagetype"))
    return offers.select(
        code.alias("service"),
        attribute(v, "regionCode").alias("region"),
        F.coalesce(usage_type, made).alias("usage_type"),
        price(v).alias("rate"),
    ).where("usage_type IS NOT NULL AND rate > 0")


def to_buckets(lines: DataFrame, start: str, end: str, granularity: str) -> DataFrame:
    """Each line once per bucket of [start, end) it overlaps, its quantity (and cost) in

    proportion to the overlapping seconds. Adds bucket_start and bucket_end. The
    buckets come from the line itself, so there is no join of lines with buckets."""
    _check_window(start, end)
    first = tb.floor_to(F.lit(start).cast("timestamp"), granularity)
    last = tb.ceil_to(F.lit(end).cast("timestamp"), granularity)
    inside = lines.where((F.col("period_start") < last) & (F.col("period_end") > first))
    buckets = tb.bucket_starts(
        F.greatest("period_start", first), F.least("period_end", last), granularity
    )
    out = inside.withColumn("bucket_start", F.explode(buckets)).withColumn(
        "bucket_end", tb.bucket_end(F.col("bucket_start"), granularity)
    )
    whole = F.greatest(tb.seconds_between(F.col("period_start"), F.col("period_end")), F.lit(1))
    part = tb.seconds_between(
        F.greatest("period_start", "bucket_start"), F.least("period_end", "bucket_end")
    )
    share = F.greatest(part, F.lit(0)) / whole
    for c in ("quantity", "cost"):
        if c in lines.columns:
            out = out.withColumn(c, F.col(c) * share)
    return out


#: What a line adds per second, 9 whole digits of it, so that sums over any bucket keep 18 places.
SLOPE = "decimal(27,18)"


def bucket_totals(
    lines: DataFrame, start: str | None, end: str | None, granularity: str, keys: list[Column], values: dict[str, Column]
) -> DataFrame:
    """Sums of ``values`` per ``keys`` and bucket of [start, end), or of all time, as ``to_buckets`` would spread the lines.

    A line gives at most three rows, however many buckets it spans: its part of the first bucket, its part
    of the last one, and between them what it adds per second, once from there on and once taken back. The
    running sum of these, over the buckets of a key that have rows at all, is what every bucket between gets.
    A line within one bucket gives one row. Sums are of decimals, so they do not depend on their order.
    """
    inside, low, high = lines, F.col("period_start"), F.col("period_end")
    if start is not None:
        _check_window(start, end)
        first = tb.floor_to(F.lit(start).cast("timestamp"), granularity)
        last = tb.ceil_to(F.lit(end).cast("timestamp"), granularity)
        inside = lines.where((low < last) & (high > first))
        low, high = F.greatest(low, first), F.least(high, last)
    names = list(values)
    staged = inside.select(
        *keys,
        *[v.alias(f"_v{i}") for i, v in enumerate(values.values())],
        low.alias("_s"),
        high.alias("_e"),
        F.greatest(tb.seconds_between(F.col("period_start"), F.col("period_end")), F.lit(1)).alias("_whole"),
    )
    groups = staged.columns[: len(keys)]
    staged = staged.withColumns(
        {"_b0": tb.floor_to(F.col("_s"), granularity), "_b1": tb.floor_to(F.col("_e") - F.expr("interval 1 microsecond"), granularity)}
    ).where("_b1 >= _b0")

    def row(bucket: Column, seconds: Column | None, turn: int) -> Column:
        parts = [bucket.alias("bucket_start")]
        for i in range(len(names)):
            value = F.col(f"_v{i}")
            direct = (value * seconds / F.col("_whole")) if seconds is not None else F.lit(0)
            parts.append(direct.cast(AMOUNT).alias(f"_d{i}"))
            parts.append((value * turn / F.col("_whole") if turn else F.lit(0)).cast(SLOPE).alias(f"_r{i}"))
        return F.struct(*parts, F.lit(turn).alias("_active"))

    second = tb.bucket_end(F.col("_b0"), granularity)
    one = F.array(row(F.col("_b0"), tb.seconds_between(F.col("_s"), F.col("_e")), 0))
    many = F.array(
        row(F.col("_b0"), tb.seconds_between(F.col("_s"), second), 0),
        row(second, None, 1),
        row(F.col("_b1"), tb.seconds_between(F.col("_b1"), F.col("_e")), -1),
    )
    events = staged.select(*groups, F.inline(F.when(F.col("_b0") == F.col("_b1"), one).otherwise(many)))
    sums = [F.sum(f"_{x}{i}").alias(f"_{x}{i}") for i in range(len(names)) for x in "dr"]
    summed = events.groupBy(*groups, "bucket_start").agg(*sums, F.sum("_active").alias("_active"))
    in_order = Window.partitionBy(*groups).orderBy("bucket_start")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    running = {f"_r{i}": F.sum(f"_r{i}").over(so_far).cast(SLOPE) for i in range(len(names))}
    running |= {"_active": F.sum("_active").over(so_far), "_next": F.lead("bucket_start").over(in_order)}
    step = tb.step_of(granularity)
    between = F.sequence("bucket_start", F.col("_next") - step, step)
    spread = summed.withColumns(running).withColumn("_all", F.when(F.col("_active") > 0, between).otherwise(F.array("bucket_start")))
    spread = spread.select("*", F.posexplode("_all").alias("_at", "_bucket"))
    size = tb.seconds_between(F.col("_bucket"), tb.bucket_end(F.col("_bucket"), granularity)).cast("decimal(10,0)")
    own = lambda i: F.when(F.col("_at") == 0, F.col(f"_d{i}")).otherwise(0)
    flow = lambda i: F.when(F.col("_active") > 0, F.col(f"_r{i}") * size).otherwise(0)
    made = [(own(i) + flow(i)).cast(AMOUNT).alias(n) for i, n in enumerate(names)]
    return spread.select(*groups, F.col("_bucket").alias("bucket_start"), *made)


def _check_window(start: str, end: str) -> None:
    if _instant(end) <= _instant(start):
        raise ValueError("end must be after start")


def _instant(text: str) -> datetime:
    """A date, a timestamp with offset or a local timestamp (read as UTC); anything else raises."""
    time = datetime.fromisoformat(str(text))
    return time if time.tzinfo else time.replace(tzinfo=UTC)


def bucket_list(spark, start: str, end: str, granularity: str) -> DataFrame:
    """All buckets of a range, also those without lines."""
    _check_window(start, end)
    s, e = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    starts = spark.range(1).select(F.explode(tb.bucket_starts(s, e, granularity)).alias("bucket_start"))
    return starts.withColumn("bucket_end", tb.bucket_end(F.col("bucket_start"), granularity))


def cost_filter(expression: dict | None) -> Column:
    """A boolean column from an And / Or / Not / Dimensions / Tags / CostCategories tree."""
    if not expression:
        return F.lit(True)
    if expression.get("And"):
        return every(cost_filter(e) for e in expression["And"])
    if expression.get("Or"):
        return some(cost_filter(e) for e in expression["Or"])
    if expression.get("Not"):
        return ~cost_filter(expression["Not"])
    if expression.get("Dimensions"):
        node = expression["Dimensions"]
        return _value_test(dimension(_key(node)), node)
    if expression.get("Tags"):
        node = expression["Tags"]
        return _value_test(F.try_element_at(F.col("tags"), F.lit(_key(node))), node)
    return F.lit(not expression.get("CostCategories"))


def _key(node: dict) -> str:
    if not node.get("Key"):
        raise ValueError("a filter needs a Key")
    return node["Key"]


def _value_test(actual: Column, node: dict) -> Column:
    values = [v for v in node.get("Values", []) if v]
    if not values:
        return actual.isNotNull()
    if "CASE_INSENSITIVE" in node.get("MatchOptions", []):
        return known(F.lower(actual).isin([v.lower() for v in values]), actual)
    return known(actual.isin(values), actual)


def cost_where(lines: DataFrame, expression: dict | None) -> DataFrame:
    return lines.where(cost_filter(expression))


def group_key(kind: str, key: str) -> Column:
    if kind == "DIMENSION":
        return F.coalesce(dimension(key), F.lit(""))
    if kind == "TAG":
        return F.coalesce(F.try_element_at(F.col("tags"), F.lit(key)), F.lit(""))
    if kind == "COST_CATEGORY":
        return F.lit("")
    raise ValueError(f"unsupported group type {kind!r}")


def cost_and_usage(
    lines: DataFrame,
    rates: DataFrame,
    start: str,
    end: str,
    granularity: str,
    metrics: list[str],
    group_by: list[tuple[str, str]] | None = None,
    expression: dict | None = None,
    monthly_credit: float = 0.0,
) -> DataFrame:
    """Totals per bucket and metric, and per group if ``group_by`` names any keys.

    (bucket_start, bucket_end, is_total, keys, metric, amount, unit). Amounts are
    text with ten decimals. A bucket without lines appears once, its metric null.
    """
    if not metrics:
        raise ValueError("name at least one metric")
    priced = price_usage(cost_where(lines, expression), rates)
    if monthly_credit > 0:
        priced = with_credits(priced, apply_credit(priced, monthly_credit), expression)
    keys = [group_key(k, v).alias(f"key{i}") for i, (k, v) in enumerate(group_by or [])]
    names = [f"key{i}" for i in range(len(keys))]
    usd = is_usd(F.col("record_type"))
    units = F.when(usd, F.coalesce("usage_unit", F.lit("USD"))).otherwise(F.col("usage_unit"))
    amounts = {"cost": F.col("cost"), "quantity": F.when(usd, 0.0).otherwise(F.col("quantity"))}
    # summed per unit first: numbers only, so this pass hashes and needs no sort
    per_unit = bucket_totals(priced, start, end, granularity, [*keys, F.coalesce(units, F.lit("")).alias("unit")], amounts)
    sums = [F.sum(c).alias(c) for c in amounts]
    # totals and groups in one pass over what is left
    sets = [["bucket_start"], ["bucket_start", *names]] if names else [["bucket_start"]]
    summed = per_unit.groupingSets(sets, "bucket_start", *names).agg(
        *sums, F.min("unit").alias("unit"), F.grouping_id().alias("gid")
    )
    values = [_metric(m) for m in metrics if m in COST_METRICS + QUANTITY_METRICS]
    long = summed.select(
        "bucket_start",
        (F.col("gid") > 0 if names else F.lit(True)).alias("is_total"),
        F.when(
            F.col("gid") == 0, F.array(*[F.col(n) for n in names]) if names else F.array().cast("array<string>")
        )
        .otherwise(F.array().cast("array<string>"))
        .alias("keys"),
        F.explode(F.array(*values)).alias("m"),
    ).select("bucket_start", "is_total", "keys", "m.*")
    buckets = bucket_list(lines.sparkSession, start, end, granularity)
    return buckets.join(long, "bucket_start", "left").select(
        "bucket_start",
        "bucket_end",
        F.coalesce("is_total", F.lit(True)).alias("is_total"),
        F.coalesce("keys", F.array().cast("array<string>")).alias("keys"),
        "metric",
        "amount",
        "unit",
    )


def _metric(name: str) -> Column:
    value, unit = (F.col("cost"), F.lit("USD")) if name in COST_METRICS else (F.col("quantity"), F.col("unit"))
    return F.struct(
        F.lit(name).alias("metric"),
        value.cast("decimal(38,10)").cast("string").alias("amount"),
        unit.alias("unit"),
    )


def apply_credit(priced: DataFrame, monthly_credit: float) -> DataFrame:
    """Credit lines: per region and month the cost of usage, at most the credit, negated.

    Lines are spread over the months they cover by their seconds.
    """
    usage = priced.where((F.col("record_type") == "Usage") & (F.col("cost") != 0))
    # per account first, so that the wide pass hashes numbers only
    keys = [F.col("region"), F.col("account")]
    spread = bucket_totals(usage.where("period_start < period_end"), None, None, "MONTHLY", keys, {"spent": F.col("cost")})
    per_account = spread.withColumnRenamed("bucket_start", "month")
    totals = per_account.groupBy("region", "month").agg(
        F.sum("spent").cast("double").alias("spent"), F.max("account").alias("account")
    )
    credit = totals.where("spent > 0").withColumn(
        "amount", -F.least(F.lit(float(monthly_credit)), F.col("spent"))
    )
    return credit.select(
        F.col("month").alias("period_start"),
        tb.bucket_end(F.col("month"), "MONTHLY").alias("period_end"),
        F.lit("Credits").alias("service"),
        "region",
        F.lit("Credit-Promotional").alias("usage_type"),
        F.lit("ApplyPromoCredit").alias("operation"),
        F.lit("Credit").alias("record_type"),
        "account",
        F.lit(None).cast("string").alias("resource"),
        F.create_map().cast("map<string,string>").alias("tags"),
        F.col("amount").alias("quantity"),
        F.lit("USD").alias("usage_unit"),
        F.col("amount").alias("cost"),
    )


def with_credits(lines: DataFrame, credits: DataFrame, expression: dict | None = None) -> DataFrame:
    """Usage lines and the credit lines that pass the same filter."""
    return lines.unionByName(cost_where(credits, expression).select(*lines.columns))


def storage_usage(objects: DataFrame, start: str, end: str, region: str) -> DataFrame:
    """Storage lines of a window from (bucket, bucket_region, tags, size): GB-months per

    bucket that holds anything, and one empty catalogue line."""
    _check_window(start, end)
    s, e = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    month_share = tb.seconds_between(s, e) / F.lit(SECONDS_PER_MONTH)
    here = objects.where(F.coalesce("bucket_region", F.lit("us-east-1")) == region)
    size = F.greatest(F.coalesce("size", F.lit(0)), F.lit(0))
    per_bucket = here.groupBy("bucket").agg(F.sum(size).alias("bytes"), F.min_by("tags", F.to_json("tags")).alias("tags"))
    used = per_bucket.where("bytes > 0").select(
        F.concat(F.lit("arn:aws:s3:::"), "bucket").alias("resource"),
        F.coalesce("tags", F.create_map().cast("map<string,string>")).alias("tags"),
        (F.col("bytes") / BYTES_PER_GB * month_share).alias("quantity"),
    )
    empty = objects.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("resource"),
        F.create_map().cast("map<string,string>").alias("tags"),
        F.lit(0.0).alias("quantity"),
    )
    return used.unionByName(empty).select(
        s.alias("period_start"),
        e.alias("period_end"),
        F.lit("AmazonS3").alias("service"),
        F.lit(region).alias("region"),
        F.lit("TimedStorage-Standard").alias("usage_type"),
        F.lit("StandardStorage").alias("operation"),
        F.lit("Usage").alias("record_type"),
        F.lit("000000000000").alias("account"),
        "resource",
        "tags",
        "quantity",
        F.lit("GB-Mo").alias("usage_unit"),
    )


def dimension_values(lines: DataFrame, name: str, search: str | None = None, expression: dict | None = None) -> DataFrame:
    """Distinct non-empty values of a dimension in text order, optionally holding a text."""
    values = cost_where(lines, expression).select(dimension(name).alias("value")).where("value <> ''")
    if search is not None:
        values = values.where(F.col("value").contains(search))
    return values.distinct().orderBy("value")


def tag_values(lines: DataFrame, key: str | None = None, search: str | None = None, expression: dict | None = None) -> DataFrame:
    """Distinct tag keys, or the values of one key, in text order."""
    rows = cost_where(lines, expression)
    if not key:
        values = rows.select(F.explode(F.map_keys("tags")).alias("value"))
    else:
        values = rows.select(F.try_element_at(F.col("tags"), F.lit(key)).alias("value")).where("value IS NOT NULL")
        if search is not None:
            values = values.where(F.col("value").contains(search))
    return values.distinct().orderBy("value")


def to_focus(lines: DataFrame, rates: DataFrame) -> DataFrame:
    """The 27 columns of the billing report per usage line."""
    month_start, month_end = tb.billing_month(F.col("period_start"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    cost = F.col("cost")
    return price_usage(lines, rates).select(
        iso(month_start).alias("BillingPeriodStart"),
        iso(month_end).alias("BillingPeriodEnd"),
        iso(F.col("period_start")).alias("ChargePeriodStart"),
        iso(F.col("period_end")).alias("ChargePeriodEnd"),
        F.col("account").alias("BillingAccountId"),
        F.col("account").alias("SubAccountId"),
        service_category(F.col("service")).alias("ServiceCategory"),
        F.col("service").alias("ServiceName"),
        F.col("region").alias("Region"),
        F.col("resource").alias("ResourceId"),
        F.col("resource").alias("ResourceName"),
        resource_type(F.col("service")).alias("ResourceType"),
        charge_category(F.col("record_type")).alias("ChargeCategory"),
        F.lit("Standard").alias("ChargeClass"),
        F.lit("Synthesized usage line").alias("ChargeDescription"),
        F.lit("Usage-Based").alias("ChargeFrequency"),
        F.col("usage_type").alias("ChargeSubcategory"),
        F.col("quantity").alias("PricingQuantity"),
        F.col("usage_unit").alias("PricingUnit"),
        F.col("quantity").alias("UsageQuantity"),
        F.col("usage_unit").alias("UsageUnit"),
        cost.alias("BilledCost"),
        cost.alias("EffectiveCost"),
        cost.alias("ListCost"),
        cost.alias("ContractedCost"),
        F.lit("USD").alias("BillingCurrency"),
        F.coalesce("tags", F.create_map().cast("map<string,string>")).alias("Tags"),
    )


def write_usage_report(lines: DataFrame, rates: DataFrame, path: str, month: str) -> None:
    """The billing report of one month ('2024-01') as Parquet, a new folder per month.

    Lines are taken by the month in which they start; a rerun replaces only its month.
    """
    start = F.lit(f"{month}-01").cast("timestamp")
    inside = lines.where(
        (F.col("period_start") >= start) & (F.col("period_start") < start + F.expr("interval 1 month"))
    )
    out = to_focus(inside, rates)
    out.write.mode("overwrite").parquet(f"{path.rstrip('/')}/billing_month={month}")
