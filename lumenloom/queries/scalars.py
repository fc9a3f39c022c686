"""The scalar function families over whole tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from lumenloom.functions import billing_maps as maps
from lumenloom.functions import collections as fc
from lumenloom.functions import numbers, text, user, vectors
from lumenloom.functions import timebuckets as tb
from lumenloom.queries.base import query_vector, table, usage, vector_literal
from lumenloom.queries.registry import query


@query(
    "string_functions",
    """SELECT p_partkey, upper(trim(concat(' ', p_name, ' '))) AS cleaned, p_name LIKE '%b_lt%' AS liked,
              regexp_matches(p_name, '^r.*t$') AS globbed, starts_with(p_name, 'red') AS begins, contains(p_name, 'ing') AS holds,
              length(p_name) + 2 AS units, concat('"', p_name, ', ""x""', '"') AS csv, concat('part ', CAST(p_partkey AS VARCHAR), ' is ', p_type, '!') AS filled
       FROM part""",
)
def string_functions(spark, d):
    name = F.col("p_name")
    return table(spark, d, "part").select(
        "p_partkey",
        text.clean_upper(F.concat(F.lit(" "), name, F.lit(" "))).alias("cleaned"),
        text.like_pattern(name, "%b_lt%").alias("liked"),
        text.glob_match(name, "r*t").alias("globbed"),
        name.startswith("red").alias("begins"),
        name.contains("ing").alias("holds"),
        # a character past the basic plane counts twice
        text.text_units(F.concat(name, F.lit("\U0001f600"))).alias("units"),
        text.csv_field(F.concat(name, F.lit(', "x"'))).alias("csv"),
        text.fill_slots("part {} is {}!", F.col("p_partkey"), F.col("p_type")).alias("filled"),
    )


@query(
    "math_functions",
    """SELECT p_partkey, CAST(round(CAST(p_retailprice / 255.0 AS DECIMAL(38,10)), 4) AS DOUBLE) AS scaled,
              CAST(p_size AS VARCHAR) AS normal, CAST(p_size + 1 AS VARCHAR) AS summed,
              CASE WHEN p_size % 2 = 0 THEN '0.5' ELSE '-0.5' END AS half, p_partkey + p_size AS added,
              CAST(p_size - 3 AS VARCHAR) AS less FROM part""",
)
def math_functions(spark, d):
    size = F.col("p_size").cast("string")
    half = F.when(F.col("p_size") % 2 == 0, "+00.500").otherwise("-5E-1")
    return table(spark, d, "part").select(
        "p_partkey",
        numbers.round_decimal(F.col("p_retailprice") / 255.0, 4).alias("scaled"),
        numbers.normalize_number(F.concat(F.lit("00"), size, F.lit(".000"))).alias("normal"),
        numbers.decimal_add(size, F.lit("1.0")).alias("summed"),
        numbers.normalize_number(half).alias("half"),
        (F.col("p_partkey") + F.col("p_size")).alias("added"),
        numbers.decimal_subtract(size, F.lit("3")).alias("less"),
    )


@query(
    "date_functions",
    """SELECT event_id, date_trunc('hour', ts) AS hour, date_trunc('day', ts) AS day, date_trunc('month', ts) AS month,
              date_trunc('day', ts) + CASE WHEN ts = date_trunc('day', ts) THEN INTERVAL 0 DAYS ELSE INTERVAL 1 DAY END AS next_day,
              date_trunc('month', ts) + INTERVAL 1 MONTH AS month_end,
              strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') AS shown, strftime(ts, '%Y/%m/%d/%H') AS tokens,
              date_trunc('second', ts) AS parsed, date_trunc('day', ts) AS parsed_date, CAST(datediff('hour', date_trunc('hour', ts), date_trunc('hour', ts) + INTERVAL 5 HOURS) AS BIGINT) AS buckets
       FROM events""",
)
def date_functions(spark, d):
    ts = F.col("ts").cast("timestamp")
    naive = lambda c: c.cast("timestamp_ntz")
    tokens = tb.path_tokens(ts)
    month_start, month_end = tb.billing_month(ts)
    return table(spark, d, "events").select(
        "event_id",
        naive(tb.floor_to(ts, "HOURLY")).alias("hour"),
        naive(tb.floor_to(ts, "DAILY")).alias("day"),
        naive(month_start).alias("month"),
        naive(tb.ceil_to(ts, "DAILY")).alias("next_day"),
        naive(month_end).alias("month_end"),
        tb.millis_to_text(F.unix_millis(ts)).alias("shown"),
        F.concat_ws("/", *[tokens[k] for k in ("year", "month", "day", "hour")]).alias("tokens"),
        naive(tb.parse_time(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))).alias("parsed"),
        naive(tb.parse_time(F.date_format(ts, "yyyy-MM-dd"))).alias("parsed_date"),
        F.size(
            tb.bucket_starts(tb.floor_to(ts, "HOURLY"), tb.floor_to(ts, "HOURLY") + F.expr("interval 5 hours"), "HOURLY")
        ).cast("bigint").alias("buckets"),
    )


@query(
    "collection_functions",
    """SELECT c_custkey, concat(c_mktsegment, ',', c_name) AS joined, concat('nation=', CAST(c_nationkey AS VARCHAR), ',segment=', c_mktsegment) AS dimension,
              c_mktsegment = 'BUILDING' AS held, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'none' END AS fallback FROM customer""",
)
def collection_functions(spark, d):
    tags = F.create_map(F.lit("segment"), "c_mktsegment", F.lit("nation"), F.col("c_nationkey").cast("string"))
    return table(spark, d, "customer").select(
        "c_custkey",
        F.array_join(fc.list_append(F.array("c_mktsegment"), F.array("c_name")), ",").alias("joined"),
        fc.dimension_key(tags).alias("dimension"),
        fc.holds_all(tags, {"segment": "BUILDING"}).alias("held"),
        fc.if_not_exists(F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")), F.lit("none")).alias("fallback"),
    )


_KINDS = "CASE o_orderkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 2 END"


@query(
    "array_functions",
    f"""SELECT o_orderkey, CAST({_KINDS} AS INTEGER) AS length,
              CASE o_orderkey % 3 WHEN 0 THEN o_orderstatus = 'F' AND o_custkey % 4 = 1 WHEN 1 THEN false END AS held,
              CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS nested,
              concat('[', CAST(o_custkey AS VARCHAR), ',"', o_orderstatus, '",null]') AS built, o_custkey + 7 AS added FROM orders""",
)
def array_functions(spark, d):
    """Length, membership at all depths, building and whole sums on JSON that Spark makes of the rows."""
    member = F.to_json(F.struct((F.col("o_custkey") % 4).alias("a"), F.col("o_orderstatus").alias("b")))
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("["), member, F.lit(',[1,{"y":2,"x":[]}],1]')))
    text = text.when(F.col("o_orderkey") % 3 == 1, F.lit('["1",1.0]')).otherwise(member)
    parsed = lambda literal: F.parse_json(F.lit(literal))
    key = F.parse_json(F.col("o_custkey").cast("string"))
    status = F.parse_json(F.concat(F.lit('"'), "o_orderstatus", F.lit('"')))
    rows = table(spark, d, "orders").select("o_orderkey", F.parse_json(text).alias("v"), key.alias("key"), status.alias("status"))
    return rows.select(
        "o_orderkey",
        fc.array_length(F.col("v")).alias("length"),
        fc.array_contains(F.col("v"), parsed('{"b":"F","a":1}')).alias("held"),
        fc.array_contains(F.col("v"), parsed('[1,{"x":[],"y":2}]')).alias("nested"),
        F.to_json(fc.array_of(F.col("key"), F.col("status"), F.lit(None).cast("variant"))).alias("built"),
        fc.add_whole(F.col("key"), parsed('"7"')).alias("added"),
    )


@query(
    "function_catalogue",
    "SELECT p_partkey, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS brand, 'brand_number' AS function FROM part",
)
def function_catalogue(spark, d):
    """A user function is registered, found in the catalogue by pattern, and called from SQL text."""

    @F.pandas_udf("bigint")
    def brand_number(brands: pd.Series) -> pd.Series:
        return brands.str.extract("([0-9]+)", expand=False).astype("Int64")

    user.register_functions(spark, {"brand_number": brand_number})
    table(spark, d, "part").createOrReplaceTempView("function_parts")
    name = user.list_functions(spark, "brand_num*", n=1).first()["function"]
    return spark.sql(f"SELECT p_partkey, {name}(p_brand) AS brand, '{name}' AS function FROM function_parts")


@query(
    "mapping_functions",
    """SELECT DISTINCT CASE l_suppkey % 5 WHEN 0 THEN 'Compute' WHEN 1 THEN 'Storage' WHEN 2 THEN 'Compute' WHEN 3 THEN 'Databases' ELSE 'Other' END AS category,
              CASE l_suppkey % 5 WHEN 0 THEN 'Instance' WHEN 1 THEN 'Bucket' WHEN 2 THEN 'Function' WHEN 3 THEN 'DBInstance' ELSE 'AmazonSNS' END AS kind,
              CASE l_linenumber WHEN 7 THEN 'Tax' WHEN 6 THEN 'Refund' ELSE 'Usage' END AS charge FROM lineitem""",
)
def mapping_functions(spark, d):
    return usage(spark, d).select(
        maps.service_category(F.col("service")).alias("category"),
        maps.resource_type(F.col("service")).alias("kind"),
        maps.charge_category(F.col("record_type")).alias("charge"),
    ).distinct()


def _vector_sql(name: str, function: str) -> str:
    value = f"{function}(CAST(embedding AS DOUBLE[]), {vector_literal(1)})"
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), 6) AS DOUBLE) AS {name}"


@query(
    "vector_functions",
    f"SELECT vec_id, {_vector_sql('dot', 'list_inner_product')}, {_vector_sql('cosine', 'list_cosine_similarity')},"
    f" {_vector_sql('euclid', 'list_distance')} FROM embeddings",
)
def vector_functions(spark, d):
    wanted = F.array(*[F.lit(x) for x in query_vector(1)])
    six = lambda c: F.round(c.cast("decimal(38,10)"), 6).cast("double")
    data = F.col("embedding")
    return table(spark, d, "embeddings").select(
        "vec_id",
        six(vectors.dot(data, wanted)).alias("dot"),
        six(vectors.cosine_similarity(data, wanted)).alias("cosine"),
        six(vectors.euclidean_distance(data, wanted)).alias("euclid"),
    )
