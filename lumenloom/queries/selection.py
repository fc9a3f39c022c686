"""Predicates, listings, pages, vectors and document items."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenloom.operators import documents as doc
from lumenloom.operators import predicates, vectors
from lumenloom.functions import collections as fc
from lumenloom.queries.base import items, query_vector, table, vector_literal
from lumenloom.queries.registry import query
from lumenloom.session import shared_dir
from lumenloom.sources import positions

# ── loose and partition predicates ───────────────────────────────────────────────

@query(
    "select_where",
    """SELECT p_partkey, p_name, size FROM (
         SELECT p_partkey, p_name, CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 'none'
                ELSE concat(CAST(p_size AS VARCHAR), CASE WHEN p_partkey % 2 = 0 THEN '.0' ELSE '' END) END AS size FROM part)
       WHERE coalesce(CASE WHEN TRY_CAST(size AS DOUBLE) IS NOT NULL THEN TRY_CAST(size AS DOUBLE) > 9 ELSE size > '9' END, false)
         AND NOT coalesce(size IN ('30', '40'), false)
         AND NOT coalesce(p_name LIKE 'r%', false)
          OR (size IS NULL AND coalesce(p_name LIKE '%_olt', false))
          OR coalesce(TRY_CAST(size AS DOUBLE) BETWEEN 3 AND 4, false)""",
)
def select_where(spark, d):
    part = table(spark, d, "part")
    text = F.concat(F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 2 == 0, ".0").otherwise(""))
    size = F.when(F.col("p_partkey") % 7 == 0, None).when(F.col("p_partkey") % 5 == 0, "none").otherwise(text)
    rows = part.select("p_partkey", "p_name", size.alias("size"))
    return predicates.where_loose(
        rows,
        lambda c: (c("SIZE").gt(9) & ~c("_3").in_([30, 40]) & ~c("p_name").like("r%"))
        | (c("size").is_null() & c("P_Name").like("%_olt"))
        | c("size").between(3, 4),
    )


@query(
    "partition_filter",
    "SELECT year, month, count(*) AS orders FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year,"
    " lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS month FROM orders)"
    " WHERE CAST(year AS INT) >= 1998 AND (CAST(month AS INT) = 1 OR month IN ('11')) GROUP BY 1, 2",
)
def partition_filter(spark, d):
    path = shared_dir(spark, "partitioned")
    orders = table(spark, d, "orders")
    dated = orders.withColumns(
        {
            "year": F.year("o_orderdate").cast("string"),
            "month": F.lpad(F.month("o_orderdate").cast("string"), 2, "0"),
        }
    )
    # rows of one partition meet in few tasks before the write, hot ones split
    dated.hint("rebalance", "year", "month").write.partitionBy("year", "month").parquet(path)
    schema = dated.schema
    kept = spark.read.schema(schema).parquet(path)
    listing = kept.groupBy("year", "month").agg(F.count("*").alias("orders"))
    return predicates.prune_partitions(
        listing, ["year", "month"], lambda c: c("year").ge(1998) & (c("month").eq(1) | c("month").in_(["1", "11"]))
    )


def _tagged(spark, d):
    c = table(spark, d, "customer")
    return c.select(
        F.concat(
            F.lit("arn:aws:"),
            F.when(F.col("c_custkey") % 2 == 0, "ec2").otherwise("S3"),
            F.lit(":"),
            F.when(F.col("c_custkey") % 3 == 0, "").otherwise("eu-west-1"),
            F.lit(":1:"),
            F.when(F.col("c_custkey") % 4 == 0, "instance/").otherwise("volume/"),
            F.lpad(F.col("c_custkey").cast("string"), 8, "0"),
        ).alias("resource"),
        F.create_map(F.lit("segment"), "c_mktsegment", F.lit("nation"), F.col("c_nationkey").cast("string")).alias("tags"),
        F.create_map(F.lit("segment"), "c_mktsegment", F.lit("name"), "c_name").alias("attributes"),
        "c_custkey",
        F.when(F.col("c_custkey") % 2 == 0, "CONFIRMED").otherwise("CREATED").alias("status"),
    )


@query(
    "tag_filter",
    "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE') AND c_custkey % 2 = 0"
    " AND c_custkey % 4 = 0 ORDER BY CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'eu-west-1' END, lpad(CAST(c_custkey AS VARCHAR), 8, '0') LIMIT 100",
)
def tag_filter(spark, d):
    found = predicates.find_by_tags(
        _tagged(spark, d), {"segment": ["BUILDING", "FURNITURE"], "nation": []}, ["EC2:Instance"], "eu-west-1", page_size=100
    )
    return found.select("c_custkey")


@query(
    "attribute_match",
    "SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_name = 'Customer#000000001'",
)
def attribute_match(spark, d):
    wanted = {"segment": "MACHINERY", "name": "Customer#000000001"}
    return predicates.match_attributes_exact(_tagged(spark, d), wanted).select("c_custkey")


@query("attribute_catalog", "SELECT DISTINCT c_mktsegment AS value FROM customer")
def attribute_catalog(spark, d):
    return predicates.attribute_values(_tagged(spark, d), "segment")


@query(
    "account_filter",
    "SELECT c_custkey, 'prefix' AS test FROM customer WHERE c_mktsegment LIKE 'B%' UNION ALL"
    " SELECT c_custkey, 'status' FROM customer WHERE c_custkey % 2 = 1",
)
def account_filter(spark, d):
    users = _tagged(spark, d)
    by_prefix = predicates.where_attr(users, "segment", "^=", "B")
    by_status = predicates.where_attr(users, "cognito:user_status", "=", "CREATED")
    return by_prefix.select("c_custkey", F.lit("prefix").alias("test")).unionByName(
        by_status.select("c_custkey", F.lit("status").alias("test"))
    )


# ── listings and pages ───────────────────────────────────────────────────────────


@query(
    "prefix_rollup",
    """SELECT entry, is_prefix FROM (
         SELECT DISTINCT entry, is_prefix FROM (
           SELECT CASE WHEN position('/' IN substr(url, 9)) > 0 THEN substr(url, 1, 8 + position('/' IN substr(url, 9))) ELSE url END AS entry,
                  position('/' IN substr(url, 9)) > 0 AS is_prefix FROM pages WHERE starts_with(url, 'https://')) WHERE is_prefix
         UNION ALL SELECT url, false FROM pages WHERE starts_with(url, 'https://') AND position('/' IN substr(url, 9)) = 0)
       WHERE entry > 'https://c'""",
)
def prefix_rollup(spark, d):
    return positions.list_prefixes(
        table(spark, d, "pages"), "https://", "/", max_keys=None, after="https://c", key="url"
    )


@query(
    "prefix_page",
    """SELECT entry, is_prefix FROM (SELECT DISTINCT regexp_extract(url, '^https?://[^/]*/', 0) AS entry, true AS is_prefix FROM pages
       WHERE starts_with(url, 'http://') ) ORDER BY entry LIMIT 20""",
)
def prefix_page(spark, d):
    """One page of a listing: objects and common prefixes together, in text order."""
    return positions.list_prefixes(table(spark, d, "pages"), "http://", "/", max_keys=20, key="url")


def _records(spark, d):
    return table(spark, d, "events").select(
        F.col("event_id").alias("sequence_number"), F.col("ts").alias("arrival"), "user_id"
    )


@query(
    "stream_read_position",
    "SELECT 'OLDEST' AS start, * FROM (SELECT event_id AS sequence_number, user_id FROM events ORDER BY event_id LIMIT 5000)"
    " UNION ALL SELECT 'AT_SEQUENCE', * FROM (SELECT event_id, user_id FROM events WHERE event_id >= 500 ORDER BY event_id LIMIT 300)"
    " UNION ALL SELECT 'AFTER_SEQUENCE', * FROM (SELECT event_id, user_id FROM events WHERE event_id > 500 ORDER BY event_id LIMIT 300)"
    " UNION ALL SELECT 'AT_TIMESTAMP', * FROM (SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-15' ORDER BY event_id LIMIT 300)"
    " UNION ALL SELECT 'LAG', (SELECT (epoch_us(max(ts)) // 1000) - (SELECT epoch_us(ts) // 1000 FROM events ORDER BY event_id LIMIT 1 OFFSET 299) FROM events), NULL",
)
def stream_read_position(spark, d):
    log = _records(spark, d)
    pages = {
        "OLDEST": positions.read_from(log, "OLDEST", limit=5000),
        "AT_SEQUENCE": positions.read_from(log, "AT_SEQUENCE", 500, 300),
        "AFTER_SEQUENCE": positions.read_from(log, "AFTER_SEQUENCE", 500, 300),
        "AT_TIMESTAMP": positions.read_from(log, "AT_TIMESTAMP", F.lit("2024-01-15").cast("timestamp_ntz"), 300),
    }
    out = positions.read_lag(log, positions.read_from(log, "OLDEST", limit=300)).select(
        F.lit("LAG").alias("start"), F.col("millis_behind").alias("sequence_number"), F.lit(None).cast("bigint").alias("user_id")
    )
    for name, page in pages.items():
        out = out.unionByName(page.select(F.lit(name).alias("start"), "sequence_number", "user_id"))
    return out


@query(
    "keyset_page",
    "SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE (o_custkey, o_orderkey) > (500, 100)"
    " ORDER BY o_custkey, o_orderkey LIMIT 400) WHERE o_orderstatus = 'F'"
    " UNION ALL SELECT o_custkey, o_orderkey, 'cursor' FROM (SELECT o_custkey, o_orderkey FROM orders"
    " WHERE (o_custkey, o_orderkey) > (500, 100) ORDER BY 1, 2 LIMIT 1 OFFSET 399)",
)
def keyset_page(spark, d):
    orders = table(spark, d, "orders")
    keys, after = ["o_custkey", "o_orderkey"], (500, 100)
    rows = doc.page(orders, keys, 400, after, F.col("o_orderstatus") == "F")
    cursor = doc.page_cursor(orders, keys, 400, after).where("o_custkey IS NOT NULL").withColumn("o_orderstatus", F.lit("cursor"))
    return rows.select(*keys, "o_orderstatus").unionByName(cursor)


@query(
    "page_by_size",
    """SELECT conv_id, turn, running_size FROM (
         SELECT conv_id, turn, strlen(text) AS size,
                CAST(sum(strlen(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS running_size FROM conversations)
       WHERE running_size <= 1500 OR running_size = size""",
)
def page_by_size(spark, d):
    turns = table(spark, d, "conversations")
    size = F.octet_length("text").cast("bigint")
    paged = doc.page_by_size(turns, ["conv_id"], ["turn"], size, 1500)
    return paged.select("conv_id", "turn", "running_size")


# ── document items ───────────────────────────────────────────────────────────────


@query(
    "doc_filter",
    """SELECT c_custkey FROM customer WHERE
         (c_acctbal >= 100.5 AND c_custkey % 3 <> 0 AND starts_with(c_mktsegment, 'B') AND c_nationkey BETWEEN 3 AND 20)
      OR (c_custkey % 3 = 0 AND c_custkey % 5 = 1 AND c_custkey % 2 = 0 AND c_acctbal < 5000)
      OR (c_custkey % 7 = 4 AND c_name LIKE '%99%')
      OR (c_nationkey = 7 AND c_acctbal > 2000 AND c_custkey % 3 <> 0 AND length(c_mktsegment) > 8)""",
)
def doc_filter(spark, d):
    def wanted(a):
        rich = a("balance").ge(100.5) & a("segment").begins_with("B") & a("home.nation").between(3, 20)
        sets = a("segment").ne("BUILDING") & a("segment").not_exists() & a("levels").contains(1) & a("vip").eq(True)
        sets = sets & ~a("balance").ge(5000) & a("levels").is_type("NS")
        listed = a("past[0]").in_([4, "4"]) & a("name").contains("99")
        tagged = a("tags").eq({"all", "n7"}) & a("balance").gt(2000) & (a("segment").size() > 8)
        return rich | sets | listed | tagged

    return doc.doc_where(items(spark, d), wanted).select("c_custkey")


@query(
    "legacy_condition",
    "SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_custkey % 3 <> 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')"
    " AND c_nationkey <> 5 AND c_name LIKE '%1%'",
)
def legacy_condition(spark, d):
    conditions = {
        "balance": ("GT", [0]),
        "segment": ("IN", ["BUILDING", "MACHINERY"]),
        "tags": ("NOT_CONTAINS", ["n5"]),
        "gone": ("NULL", []),
        "home": ("NOT_NULL", []),
        "name": ("CONTAINS", ["1"]),
    }
    return doc.doc_where_legacy(items(spark, d), conditions).select("c_custkey")


@query(
    "key_query",
    "SELECT * FROM (SELECT event_id, user_id, ts, event_type FROM events WHERE user_id = 41 AND ts >= TIMESTAMP '2024-01-05'"
    " AND event_id % 4 <> 0 AND event_id % 9 <> 0 ORDER BY ts DESC LIMIT 40) WHERE event_type <> 'view'",
)
def key_query(spark, d):
    events = table(spark, d, "events")
    events = events.withColumns(
        {
            # an index key is missing on some rows, some others have expired, one expiry is no number
            "sort_ts": F.when(F.col("event_id") % 9 != 0, F.col("ts")),
            "expires": F.when(F.col("event_id") % 4 == 0, "99").when(F.col("event_id") % 4 == 1, "soon").otherwise("101"),
        }
    )
    found = doc.key_query(
        events,
        ("user_id", 41),
        "sort_ts",
        F.col("sort_ts") >= F.lit("2024-01-05").cast("timestamp_ntz"),
        forward=False,
        limit=40,
        filter_test=F.col("event_type") != "view",
        index=True,
        expires=("expires", 100),
    )
    return found.select("event_id", "user_id", "ts", "event_type")


@query(
    "ttl_filter",
    "SELECT event_id FROM events WHERE NOT (epoch_us(ts) // 1000000 < 1705276800 AND event_id % 10 <> 0)",
)
def ttl_filter(spark, d):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    rows = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 10 == 0, "never").otherwise(seconds).alias("expires")
    )
    return doc.drop_expired(rows, "expires", 1705276800).select("event_id")


@query(
    "batch_key_lookup",
    "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50 AND l_discount = 0.05)",
)
def batch_key_lookup(spark, d):
    wanted = table(spark, d, "lineitem").where("l_quantity = 50 AND l_discount = 0.05D")
    keys = wanted.select(F.col("l_partkey").alias("p_partkey"))
    return doc.lookup(table(spark, d, "part").select("p_partkey", "p_name"), keys, "p_partkey")


_ITEM_SIZE = (
    "2 + strlen(CAST(c_custkey AS VARCHAR)) + 4 + strlen(c_name) + 7 + strlen(CAST(c_acctbal AS VARCHAR)) + 3 + 1"
    " + CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 7 + strlen(c_mktsegment) END"
    " + 4 + (1 + strlen(CAST(c_nationkey AS VARCHAR)) + 1) + 4"
    " + 6 + 2 + 5 + 4 + 6 + 4 + strlen(CAST(c_nationkey AS VARCHAR)) + 4 + 4 + 4"
)


@query("item_size", f"SELECT c_custkey, CAST({_ITEM_SIZE} AS BIGINT) AS bytes FROM customer")
def item_size(spark, d):
    return items(spark, d).select("c_custkey", doc.item_size("item").alias("bytes"))


@query(
    "set_add",
    "SELECT l_orderkey, l_linenumber, concat_ws(',', l_returnflag, l_linestatus,"
    " CASE WHEN l_returnflag = 'A' THEN NULL ELSE 'A' END, CASE WHEN l_linestatus = 'O' THEN NULL ELSE 'O' END) AS flags FROM lineitem",
)
def set_add(spark, d):
    lines = table(spark, d, "lineitem")
    joined = fc.set_add(F.array("l_returnflag", "l_linestatus"), F.array(F.lit("A"), F.lit("O")))
    return lines.select("l_orderkey", "l_linenumber", F.array_join(joined, ",").alias("flags"))


@query(
    "set_remove",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN NULL ELSE concat_ws(',',"
    " CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_returnflag END, CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_linestatus END) END AS flags FROM lineitem",
)
def set_remove(spark, d):
    lines = table(spark, d, "lineitem")
    left = fc.set_remove(F.array("l_returnflag", "l_linestatus"), F.array(F.lit("A"), F.lit("O")))
    flags = F.when(left.isNotNull(), F.array_join(left, ","))
    return lines.select("l_orderkey", "l_linenumber", flags.alias("flags"))


# ── vectors ──────────────────────────────────────────────────────────────────────


def _score(n: int, metric: str) -> str:
    function = "list_cosine_similarity" if metric == "cosine" else "list_distance"
    score = f"{function}(CAST(embedding AS DOUBLE[]), {vector_literal(n)})"
    return f"CAST(round(CAST({score} AS DECIMAL(38,10)), 6) AS DOUBLE)"


def _top(n: int, metric: str, k: int) -> str:
    direction = "DESC" if metric == "cosine" else "ASC"
    return (
        f"SELECT {n} AS query, vec_id, score FROM (SELECT vec_id, {_score(n, metric)} AS score FROM embeddings)"
        f" ORDER BY score {direction}, vec_id LIMIT {k}"
    )


def _six(df):
    return df.withColumn("score", F.round(F.col("score").cast("decimal(38,10)"), 6).cast("double"))


@query("vector_topk", f"SELECT vec_id, score FROM ({_top(0, 'cosine', 10)})")
def vector_topk(spark, d):
    return _six(vectors.vector_topk(table(spark, d, "embeddings"), query_vector(0), 10, "cosine", "vec_id", "embedding"))


@query(
    "vector_topk_euclidean",
    " UNION ALL ".join(f"SELECT * FROM ({_top(n, 'euclidean', 5)})" for n in range(3)),
)
def vector_topk_euclidean(spark, d):
    queries = [query_vector(n) for n in range(3)]
    return _six(
        vectors.vector_topk_many(table(spark, d, "embeddings"), queries, 5, "euclidean", "vec_id", "embedding")
    )
