"""Event patterns, rules, subscriptions, choices and templates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenloom.functions import json_paths as jp
from lumenloom.operators import patterns, reshape, routing
from lumenloom.queries.base import EVENT_COLUMNS, EVENTS, bus_events, items, spark_columns, table
from lumenloom.queries.registry import query
from lumenloom.session import shared_dir

# ── patterns ─────────────────────────────────────────────────────────────────────

BUS_PATTERN = {
    "source": [{"prefix": "shop.p"}, "shop.view"],
    "detail-type": [{"equals-ignore-case": "ORDER placed"}],
    "region": [{"anything-but": ["ap-south-1", "eu-west-1"]}],
    "ignored": ["whatever"],
    "detail": {
        "$or": [{"tag": [{"suffix": "3"}, None]}, {"info": {"flag": ["true"]}}],
        "tag": [{"anything-but": ["t4"]}, {"exists": False}],
        "raw": {"n": [{"exists": True}]},
        "k": [{"anything-but": {"prefix": "9"}}],
    },
    "resources": [{"prefix": "user/1"}],
}


@query(
    "event_pattern",
    f"""SELECT event_id FROM ({EVENTS}) WHERE event_type IN ('purchase', 'view') AND detail_type = 'Order Placed'
        AND region = 'us-east-1' AND (tag IS NULL OR tag = 't3' OR flag) AND coalesce(tag, '') <> 't4'
        AND NOT starts_with(CAST(k AS VARCHAR), '9') AND starts_with(CAST(user_id AS VARCHAR), '1')""",
)
def event_pattern(spark, d):
    return patterns.match_event(bus_events(spark, d), BUS_PATTERN).select("event_id")


RECORD_FILTERS = [
    {"kind": ["error", {"prefix": "vi"}], "k": [{"numeric": [">=", 20, "<", 60]}], "tag": [{"anything-but": ["t1", "t2"]}]},
    {"raw": {"n": [7, 8.0]}, "info": {"flag": [{"exists": True}]}},
    {"kind": ["purchase"], "tag": [None], "k": [{"anything-but": [1, 2, 3]}]},
    {"kind": "click"},
]


@query(
    "record_filter",
    f"""SELECT event_id FROM ({EVENTS}) WHERE
          (event_type IN ('error', 'view') AND k >= 20 AND k < 60 AND coalesce(tag, '') NOT IN ('t1', 't2'))
       OR k IN (7, 8) OR (event_type = 'purchase' AND tag IS NULL AND k NOT IN (1, 2, 3))""",
)
def record_filter(spark, d):
    return patterns.match_record(bus_events(spark, d), RECORD_FILTERS, "detail").select("event_id")


def _messages(spark, d):
    """Messages with their body, topic and attributes, all from one row of the table."""
    events = table(spark, d, "events").selectExpr(*spark_columns(EVENT_COLUMNS), "user_id", "props", "event_type AS topic")
    k = F.regexp_extract("props", "([0-9]+)", 1).alias("k")
    messages = events.select("event_id", F.col("detail").alias("body"), "user_id", k, "topic")
    level = F.when(F.col("event_id") % 3 == 0, None).otherwise(F.concat(F.lit("l"), (F.col("event_id") % 4).cast("string")))
    attributes = F.map_filter(
        F.create_map(F.lit("k"), "k", F.lit("level"), level, F.lit("user"), F.col("user_id").cast("string")),
        lambda _, v: v.isNotNull(),
    )
    return messages.withColumn("attributes", attributes)


_LEVEL = "CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('l', CAST(event_id % 4 AS STRING)) END"


@query(
    "attribute_policy",
    f"""SELECT event_id FROM (SELECT *, {_LEVEL} AS level FROM ({EVENTS})) WHERE ((k > 10 AND k <= 50) OR k = 77)
        AND (level IS NULL OR level = 'l1' OR level NOT IN ('l0', 'l2'))""",
)
def attribute_policy(spark, d):
    policy = {
        "k": [{"numeric": [">", 10, "<=", 50]}, 77.0],
        "level": [{"exists": False}, "l1", {"anything-but": ["l0", "l2"]}],
    }
    return patterns.match_attributes(_messages(spark, d), policy).select("event_id")


@query(
    "body_policy",
    f"""SELECT event_id FROM ({EVENTS}) WHERE (mark IN ('m1', 'm2') OR (mark IS NOT NULL AND k = 9))
        AND flag AND (tag IS NOT NULL AND tag <> 't5')""",
)
def body_policy(spark, d):
    policy = {"marks": [{"prefix": "m1"}, "m2", 9], "info": {"flag": [True]}, "tag": [{"anything-but": ["t5"]}]}
    return patterns.match_body(_messages(spark, d), policy).select("event_id")


RULES = [
    {"name": "all", "bus": "audit", "pattern": None, "targets": ["store"]},
    {"name": "orders", "bus": "default", "pattern": {"detail-type": ["Order Placed"], "detail": {"kind": ["purchase"]}}, "targets": ["queue", "mail"]},
    {"name": "tagged", "bus": "default", "pattern": '{"detail": {"tag": [{"exists": true}]}}', "targets": ["lake"]},
    {"name": "off", "bus": "default", "pattern": None, "targets": ["nowhere"], "enabled": False},
]

RULES_SQL = f"""
SELECT event_id, 'all' AS rule, 'store' AS target FROM ({EVENTS}) WHERE bus = 'audit'
UNION ALL SELECT event_id, 'orders', unnest(['queue', 'mail']) FROM ({EVENTS})
  WHERE bus = 'default' AND detail_type = 'Order Placed' AND event_type = 'purchase'
UNION ALL SELECT event_id, 'tagged', 'lake' FROM ({EVENTS}) WHERE bus = 'default' AND tag IS NOT NULL"""


@query("event_rule_match", RULES_SQL)
def event_rule_match(spark, d):
    return routing.match_rules(bus_events(spark, d), RULES).select("event_id", "rule", "target")


SUBSCRIPTIONS = [
    {"name": "everything", "topic": "error"},
    {"name": "by-level", "topic": "error", "policy": {"level": ["l1", "l2"]}},
    {"name": "by-body", "topic": "view", "policy": {"k": [{"numeric": ["<", 30]}]}, "scope": "body"},
    {"name": "broken", "topic": "view", "policy": "{not json"},
    {"name": "pending", "topic": "view", "pending": True},
]


@query(
    "subscription_fanout",
    f"""SELECT event_id, 'everything' AS subscription FROM ({EVENTS}) WHERE event_type = 'error'
        UNION ALL SELECT event_id, 'by-level' FROM (SELECT *, {_LEVEL} AS level FROM ({EVENTS}))
          WHERE event_type = 'error' AND level IN ('l1', 'l2')
        UNION ALL SELECT event_id, 'by-body' FROM ({EVENTS}) WHERE event_type = 'view' AND k < 30""",
)
def subscription_fanout(spark, d):
    return routing.fan_out(_messages(spark, d), SUBSCRIPTIONS).select("event_id", "subscription")


@query(
    "topic_match",
    """SELECT event_id, 'one-level' AS rule FROM events WHERE event_type = 'click'
       UNION ALL SELECT event_id, 'rest' FROM events WHERE user_id % 2 = 0
       UNION ALL SELECT event_id, 'exact' FROM events WHERE user_id = 7 AND event_type = 'view'""",
)
def topic_match(spark, d):
    side = F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd")
    topic = F.concat_ws("/", F.lit("dev"), side, F.col("user_id").cast("string"), F.col("event_type"))
    rules = [
        {"name": "one-level", "filter": "dev/+/+/click"},
        {"name": "rest", "filter": "dev/even/#"},
        {"name": "exact", "filter": "dev/odd/7/view"},
        {"name": "too-short", "filter": "dev/odd"},
        {"name": "hash-inside", "filter": "dev/#/click"},
        {"name": "off", "filter": "#", "enabled": False},
    ]
    messages = table(spark, d, "events").withColumn("topic", topic)
    return routing.match_topic(messages, rules).select("event_id", "rule")


@query(
    "choice_rules",
    f"""SELECT event_id, CASE WHEN event_type = 'purchase' AND k > 50 THEN 'big'
              WHEN tag IS NULL AND event_id % 5 = 0 THEN 'no-tag' WHEN tag LIKE 't%' AND NOT flag THEN 'glob'
              WHEN k = user_id THEN 'same' WHEN k <= 10 OR flag THEN 'small' ELSE 'rest' END AS next FROM ({EVENTS})""",
)
def choice_rules(spark, d):
    rules = [
        {"And": [{"Variable": "$.kind", "StringEquals": "purchase"}, {"Variable": "$.k", "NumericGreaterThan": 50}], "Next": "big"},
        {"Variable": "$.tag", "IsPresent": False, "Next": "no-tag"},
        {"And": [{"Variable": "$.tag", "StringMatches": "t*"}, {"Not": {"Variable": "$.info.flag", "BooleanEquals": True}}], "Next": "glob"},
        {"Variable": "$.k", "NumericEqualsPath": "$.user", "Next": "same"},
        {"Or": [{"Variable": "$.k", "NumericLessThanEquals": 10}, {"Variable": "$.info.flag", "BooleanEquals": True}], "Next": "small"},
    ]
    return routing.route(bus_events(spark, d), rules, "rest", "detail").select("event_id", "next")


# ── archive, replay, dead letters ────────────────────────────────────────────────

_ARCHIVED = f"SELECT * FROM ({EVENTS}) WHERE event_type IN ('purchase', 'error') AND flag"
_ARCHIVE_PATTERN = {"source": ["shop.purchase", "shop.error"], "detail": {"info": {"flag": ["true"]}}}


@query(
    "event_archive",
    f"SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, count(*) AS events FROM ({_ARCHIVED}) GROUP BY 1",
)
def event_archive(spark, d):
    stored = routing.archive(bus_events(spark, d), _ARCHIVE_PATTERN, shared_dir(spark, "archive"))
    return stored.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(F.count("*").alias("events"))


@query(
    "event_replay",
    RULES_SQL.replace(
        f"({EVENTS})",
        f"(SELECT * FROM ({_ARCHIVED}) WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20')",
    ),
)
def event_replay(spark, d):
    stored = routing.archive(bus_events(spark, d), _ARCHIVE_PATTERN, shared_dir(spark, "replay"))
    again = routing.replay(stored, "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    return routing.match_rules(again, RULES).select("event_id", "rule", "target")


@query(
    "receive_limit",
    "SELECT user_id, count(*) AS receive_count FROM events GROUP BY 1 HAVING count(*) > 70",
)
def receive_limit(spark, d):
    return routing.over_received(table(spark, d, "events"), 70, "user_id")


@query(
    "shard_assignment",
    "SELECT CAST(CAST(concat('0x', substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 7 AS INTEGER) AS shard,"
    " count(*) AS records, count(DISTINCT user_id) AS keys FROM events GROUP BY 1",
)
def shard_assignment(spark, d):
    shard = routing.shard_of(F.col("user_id").cast("string"), 7)
    return table(spark, d, "events").groupBy(shard.alias("shard")).agg(
        F.count("*").alias("records"), F.count_distinct("user_id").alias("keys")
    )


@query(
    "enrichment_join",
    "SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0",
)
def enrichment_join(spark, d):
    rich = table(spark, d, "customer").where("c_acctbal > 0")
    reference = rich.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return routing.enrich(table(spark, d, "orders"), reference, "o_custkey").select("o_orderkey", "c_name", "c_mktsegment")


# ── reshaping ────────────────────────────────────────────────────────────────────


@query(
    "message_template",
    f"""SELECT event_id, concat('k=', CAST(k AS VARCHAR), ' of "', event_type, '" raw ', CAST(k AS VARCHAR), ' tag ',
              CASE WHEN tag IS NULL THEN '' ELSE concat('"', tag, '"') END, '.') AS quoted,
              concat('Kind ', event_type, ' flag ', CASE WHEN flag THEN 'true' ELSE 'false' END, ' <other> ', coalesce(tag, '')) AS bare FROM ({EVENTS})""",
)
def message_template(spark, d):
    rows = bus_events(spark, d).select("event_id", "detail")
    rows = reshape.render(rows, "k=<$.k> of <$.kind> raw <$.raw.n> tag <$.tag>.", "detail").withColumnRenamed("rendered", "quoted")
    paths = {"kind": "$.kind", "flag": "$.info.flag", "tag": "$.tag"}
    rows = reshape.render(rows, "Kind <kind> flag <flag> <other> <tag>", "detail", paths).withColumnRenamed("rendered", "bare")
    return rows.select("event_id", "quoted", "bare")


@query(
    "item_reshape",
    "SELECT vec_id, i - 1 AS index, label, CAST(round(CAST(CAST(embedding[i] AS DOUBLE) * 2 AS DECIMAL(38,10)), 6) AS DOUBLE) AS twice, 'v' AS kind"
    " FROM embeddings, (SELECT unnest(range(1, 65)) AS i)",
)
def item_reshape(spark, d):
    def selector(x, i):
        twice = F.round((x.cast("double") * 2).cast("decimal(38,10)"), 6).cast("double")
        return F.struct(i.cast("bigint").alias("index"), F.col("label"), twice.alias("twice"), F.lit("v").alias("kind"))

    mapped = reshape.map_items(table(spark, d, "embeddings"), "embedding", selector)
    return mapped.select("vec_id", F.explode("mapped").alias("m")).select("vec_id", "m.*")


@query(
    "project_paths",
    """SELECT c_custkey, concat('{"home":{"M":{"nation":{"N":"', CAST(c_nationkey AS VARCHAR), '"}}},"past":{"L":[{"N":"',
              CAST(c_custkey % 7 AS VARCHAR), '"}]}', CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat(',"segment":{"S":"', c_mktsegment, '"}') END, '}') AS projected
       FROM customer""",
)
def project_paths(spark, d):
    paths = ["home.M.nation", "past.L[0]", "segment", "absent.M.x"]
    return reshape.project_paths(items(spark, d), paths).select("c_custkey", "projected")


@query(
    "json_functions",
    f"""SELECT event_id, event_type AS kind, CAST(k AS VARCHAR) AS inner_number, mark AS first_mark,
              CASE WHEN flag THEN 'true' ELSE 'false' END AS flag, concat('{{"flag":', CASE WHEN flag THEN 'true' ELSE 'false' END, '}}') AS info FROM ({EVENTS})""",
)
def json_functions(spark, d):
    v = jp.parse(F.col("detail"))
    mark = jp.at(v, ["marks", 0])
    return bus_events(spark, d).select(
        "event_id",
        jp.at(v, ["kind"], "string").alias("kind"),
        jp.as_text(jp.walk(F.col("detail"), "$.raw.n")).alias("inner_number"),
        jp.as_text(mark).alias("first_mark"),
        jp.at(v, jp.segments("info.flag"), "string").alias("flag"),
        F.to_json(jp.at(v, ["info"])).alias("info"),
    )
