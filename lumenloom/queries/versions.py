"""Versions of rows, de-duplication, updates and device state."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenloom.operators import changes, devices
from lumenloom.queries.base import table
from lumenloom.queries.registry import query


def order_log(spark, d):
    """Orders as versions of a customer's state, by order key."""
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "latest_image",
    "SELECT o_custkey, o_orderkey, lag(o_orderstatus) OVER w AS old_status, lag(o_totalprice) OVER w AS old_price"
    " FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)",
)
def latest_image(spark, d):
    out = changes.with_old_image(order_log(spark, d), ["o_custkey"], "o_orderkey")
    return out.select(
        "o_custkey",
        "o_orderkey",
        F.col("old_image.o_orderstatus").alias("old_status"),
        F.col("old_image.o_totalprice").alias("old_price"),
    )


CDC_SQL = """
SELECT o_custkey, o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN 'REMOVE' WHEN old IS NULL OR old = 'F' THEN 'INSERT' ELSE 'MODIFY' END AS event_name,
       CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS new_price,
       CASE WHEN old <> 'F' THEN old_price END AS old_price
FROM (SELECT *, lag(o_orderstatus) OVER w AS old, lag(o_totalprice) OVER w AS old_price FROM orders
      WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
WHERE o_orderstatus <> 'F' OR coalesce(old, 'F') <> 'F'"""


@query("change_images", CDC_SQL)
def change_images(spark, d):
    events = changes.cdc_images(
        order_log(spark, d),
        ["o_custkey"],
        "o_orderkey",
        deleted=F.col("o_orderstatus") == "F",
    )
    return events.select(
        "o_custkey",
        "o_orderkey",
        "event_name",
        F.col("new_image.o_totalprice").alias("new_price"),
        F.col("old_image.o_totalprice").alias("old_price"),
    )


@query(
    "table_versions",
    "SELECT o_custkey, o_orderkey, row_number() OVER w AS version, lead(o_orderkey) OVER w AS valid_to,"
    " lead(o_orderkey) OVER w IS NULL AS is_current FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)",
)
def table_versions(spark, d):
    log = order_log(spark, d).select("o_custkey", "o_orderkey")
    out = changes.versions(log, ["o_custkey"], "o_orderkey")
    return out.select("o_custkey", "o_orderkey", "version", "valid_to", "is_current")


@query(
    "upsert_latest",
    "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER"
    " (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders) WHERE n = 1",
)
def upsert_latest(spark, d):
    log = order_log(spark, d)
    old, new = log.where("o_orderkey % 3 = 0"), log.where("o_orderkey % 3 <> 0")
    return changes.upsert_latest(old, new, ["o_custkey"], "o_orderkey")


@query(
    "apply_updates",
    """SELECT coalesce(c_custkey, k) AS c_custkey,
              CASE op WHEN 'put' THEN 'put' WHEN 'update' THEN coalesce(CASE WHEN n > 12 THEN 'busy' END, c_mktsegment) ELSE c_mktsegment END AS c_mktsegment,
              CAST(round(CAST(CASE op WHEN 'put' THEN paid WHEN 'update' THEN coalesce(c_acctbal, 0) + paid ELSE c_acctbal END AS DECIMAL(38,10)), 4) AS DOUBLE) AS c_acctbal,
              CASE op WHEN 'put' THEN NULL WHEN 'update' THEN CASE WHEN c_custkey IS NULL THEN 'new' ELSE concat(c_name, ',new') END ELSE c_name END AS names
       FROM customer
       FULL JOIN (SELECT k, count(*) AS n, CAST(count(*) AS DOUBLE) AS paid,
                         CASE k % 4 WHEN 0 THEN 'put' WHEN 1 THEN 'delete' ELSE 'update' END AS op
                  FROM (SELECT CASE WHEN o_custkey % 10 = 9 THEN o_custkey + 10000000 ELSE o_custkey END AS k FROM orders) GROUP BY 1) ON k = c_custkey
       WHERE (op IS NULL) OR op <> 'delete'""",
)
def apply_updates(spark, d):
    base = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", F.array("c_name").alias("names"))
    kind = F.when(F.col("o_custkey") % 4 == 0, "put").when(F.col("o_custkey") % 4 == 1, "delete").otherwise("update")
    # one key in ten is of no customer
    key = F.when(F.col("o_custkey") % 10 == 9, F.col("o_custkey") + 10_000_000).otherwise(F.col("o_custkey"))
    per_customer = table(spark, d, "orders").groupBy(key.alias("o_custkey")).agg(F.count("*").alias("n"))
    change = per_customer.select(
        F.col("o_custkey").alias("c_custkey"),
        kind.alias("op"),
        F.when(kind == "put", "put").when(F.col("n") > 12, "busy").alias("c_mktsegment"),
        F.col("n").cast("double").alias("c_acctbal"),
        F.when(kind != "put", F.array(F.lit("new"))).alias("names"),
    )
    out = changes.apply_updates(
        base, change, ["c_custkey"], set_values=["c_mktsegment"], add_numbers=["c_acctbal"], append_lists=["names"]
    )
    return out.select(
        "c_custkey",
        "c_mktsegment",
        F.round(F.col("c_acctbal").cast("decimal(38,10)"), 4).cast("double").alias("c_acctbal"),
        F.when(F.col("names").isNotNull(), F.array_join("names", ",")).alias("names"),
    )


FIFO_SQL = """
WITH RECURSIVE accepted AS (
    SELECT event_type, min(ts) AS ts FROM events GROUP BY 1
    UNION ALL
    SELECT a.event_type, min(e.ts) FROM accepted a JOIN events e
      ON e.event_type = a.event_type AND e.ts >= a.ts + INTERVAL 300 SECONDS GROUP BY a.event_type)
SELECT e.event_id, e.event_type FROM events e JOIN accepted a ON e.event_type = a.event_type AND e.ts = a.ts"""


@query("fifo_dedup", FIFO_SQL)
def fifo_dedup(spark, d):
    events = table(spark, d, "events").select("event_id", "ts", "event_type")
    return changes.fifo_dedup(events, ["event_type"], "ts", 300, ["event_id"]).select("event_id", "event_type")


def patches(spark, d):
    return patch_rows(table(spark, d, "events"))


def patch_rows(events):
    """Device patches as rows: each event sets one key; some remove it or a whole section."""
    k = F.regexp_extract("props", "([0-9]+)", 1)
    return events.select(
        (F.col("user_id") % 20).cast("string").alias("device"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 3 == 0, "reported").otherwise("desired").alias("section"),
        F.when(F.col("event_id") % 400 != 399, F.concat("event_type", (F.col("user_id") % 7).cast("string"))).alias("key"),
        F.when(F.col("event_id") % 8 != 7, k).alias("value"),
    )


STATE_SQL = """
SELECT device, section, key, value FROM (
    SELECT *, row_number() OVER (PARTITION BY device, section, key ORDER BY seq DESC) AS n,
           max(CASE WHEN key IS NULL THEN seq END) OVER (PARTITION BY device, section) AS cleared
    FROM (SELECT CAST(user_id % 20 AS VARCHAR) AS device, event_id AS seq,
                 CASE WHEN event_id % 3 = 0 THEN 'reported' ELSE 'desired' END AS section,
                 CASE WHEN event_id % 400 <> 399 THEN concat(event_type, CAST(user_id % 7 AS VARCHAR)) END AS key,
                 CASE WHEN event_id % 8 <> 7 THEN regexp_extract(props, '([0-9]+)', 1) END AS value FROM events))
WHERE n = 1 AND key IS NOT NULL AND value IS NOT NULL AND seq > coalesce(cleared, -1)"""


@query("device_state", STATE_SQL)
def device_state(spark, d):
    return devices.merge_state(patches(spark, d))


@query(
    "device_versions",
    "SELECT CAST(user_id % 20 AS VARCHAR) AS device, count(*) AS version FROM events GROUP BY 1",
)
def device_versions(spark, d):
    return devices.state_versions(patches(spark, d))
