"""Tables, and stand-ins derived from them for data the tables do not hold.

A stand-in is a list of (expression, alias) pairs. Expressions that both dialects
read are written once; a pair of texts gives the Spark and the DuckDB wording.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

Expression = str | tuple[str, str]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spark_columns(columns: list[tuple[Expression, str]]) -> list[str]:
    return [f"{e if isinstance(e, str) else e[0]} AS {name}" for e, name in columns]


def duck_select(columns: list[tuple[Expression, str]], source: str) -> str:
    body = ", ".join(f"{e if isinstance(e, str) else e[1]} AS {name}" for e, name in columns)
    return f"SELECT {body} FROM {source}"


# ── raw products from part ───────────────────────────────────────────────────────


def _channel(factor: int, modulo: int) -> str:
    return f"CAST((p_partkey * {factor}) % {modulo} AS DOUBLE)"


def _deviation(factor: int) -> str:
    return f"CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE {_channel(factor, 90)} END"


_R, _G, _B = _channel(31, 256), _channel(37, 256), _channel(41, 256)

PRODUCT_COLUMNS: list[tuple[Expression, str]] = [
    ("CAST(p_partkey AS INT)", "ID"),
    ("CASE p_partkey % 3 WHEN 0 THEN ' men ' WHEN 1 THEN 'Women' ELSE 'unisex ' END", "GENDER"),
    ("CASE WHEN p_partkey % 400 = 1 THEN 'Rare' ELSE concat(' ', lower(p_type)) END", "MASTER_CATEGORY"),
    ("p_brand", "SUB_CATEGORY"),
    ("split_part(p_name, ' ', 1)", "ARTICLE_TYPE"),
    ("split_part(p_name, ' ', -1)", "BASE_COLOUR"),
    ("CASE p_partkey % 4 WHEN 0 THEN 'Spring' WHEN 1 THEN 'summer ' WHEN 2 THEN 'Fall' ELSE 'winter' END", "SEASON"),
    ("2010 + p_size % 9", "YEAR"),
    ("p_brand", "USAGE"),
    ("concat(' ', p_name, ' ')", "PRODUCT_DISPLAY_NAME"),
    (_R, "MEAN_R"),
    (_G, "MEAN_G"),
    (_B, "MEAN_B"),
    (_deviation(13), "STD_R"),
    (_deviation(17), "STD_G"),
    (_deviation(19), "STD_B"),
    (f"CAST(0.299 AS DOUBLE) * {_R} + CAST(0.587 AS DOUBLE) * {_G} + CAST(0.114 AS DOUBLE) * {_B}", "BRIGHTNESS"),
    ("CAST(p_partkey * 101 AS INT)", "FILE_SIZE_BYTES"),
    (_channel(43, 256), "SATURACAO_MEDIA"),
    (_channel(47, 256), "COMPLEXIDADE_VISUAL"),
    (_channel(53, 128), "CONTRASTE_LUMINANCIA"),
]


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(*spark_columns(PRODUCT_COLUMNS))


RAW = duck_select(PRODUCT_COLUMNS, "part")

SILVER = f"""
SELECT ID AS id, upper(trim(GENDER)) AS gender, upper(trim(MASTER_CATEGORY)) AS master_category,
       upper(trim(SUB_CATEGORY)) AS sub_category, upper(trim(ARTICLE_TYPE)) AS article_type,
       upper(trim(BASE_COLOUR)) AS base_colour, upper(trim(SEASON)) AS season, YEAR AS year,
       upper(trim(USAGE)) AS usage, trim(PRODUCT_DISPLAY_NAME) AS product_display_name,
       MEAN_R AS mean_r, MEAN_G AS mean_g, MEAN_B AS mean_b, FILE_SIZE_BYTES AS file_size_bytes,
       BRIGHTNESS AS brightness, STD_R AS std_r, STD_G AS std_g, STD_B AS std_b,
       SATURACAO_MEDIA AS saturacao_media, COMPLEXIDADE_VISUAL AS complexidade_visual,
       CONTRASTE_LUMINANCIA AS contraste_luminancia,
       CASE WHEN (STD_R + STD_G + STD_B) / 3 > 45 THEN true ELSE false END AS is_multicolored
FROM ({RAW})"""

DIMENSION = f"""
SELECT id AS produto_id, gender AS genero, master_category AS categoria_principal,
       sub_category AS subcategoria, article_type AS tipo_artigo, base_colour AS cor_base,
       season AS estacao, year AS ano_lancamento, usage AS ocasiao_uso,
       product_display_name AS nome_produto, mean_r AS media_vermelho, mean_g AS media_verde,
       mean_b AS media_azul, std_r AS desvio_vermelho, std_g AS desvio_verde, std_b AS desvio_azul,
       brightness AS brilho, is_multicolored AS multicolorido, saturacao_media,
       complexidade_visual, contraste_luminancia
FROM ({SILVER}) WHERE id IS NOT NULL"""


def _scaled(c: str) -> str:
    return f"CAST(round(CAST({c} / 255.0 AS DECIMAL(38,10)), 4) AS DOUBLE) AS {c}_norm"


ML = f"""
SELECT produto_id, genero, subcategoria, tipo_artigo, cor_base, estacao, ocasiao_uso,
       {', '.join(_scaled(c) for c in (
           'media_vermelho', 'media_verde', 'media_azul', 'brilho', 'saturacao_media',
           'contraste_luminancia', 'complexidade_visual'))},
       categoria_principal AS target_categoria_principal
FROM ({DIMENSION}) base
WHERE categoria_principal IS NOT NULL AND categoria_principal IN (
    SELECT categoria_principal FROM ({DIMENSION}) GROUP BY categoria_principal HAVING count(*) >= 10)"""


def _average(name: str, c: str) -> str:
    return f"CAST(round(CAST(avg({c}) AS DECIMAL(38,10)), 2) AS DOUBLE) AS {name}"


REPORT = f"""
SELECT categoria_principal, subcategoria, genero, estacao, count(produto_id) AS total_produtos,
       {_average('avg_vermelho', 'media_vermelho')}, {_average('avg_verde', 'media_verde')},
       {_average('avg_azul', 'media_azul')}, {_average('avg_desvio_vermelho', 'desvio_vermelho')},
       {_average('avg_desvio_verde', 'desvio_verde')}, {_average('avg_desvio_azul', 'desvio_azul')},
       CAST(round(CAST(100.0 * sum(CASE WHEN multicolorido THEN 1 ELSE 0 END) / count(produto_id)
            AS DECIMAL(38,10)), 2) AS DOUBLE) AS pct_multicolorido,
       {_average('avg_brilho', 'brilho')}, {_average('avg_saturacao', 'saturacao_media')},
       {_average('avg_complexidade_visual', 'complexidade_visual')},
       {_average('avg_contraste_luminancia', 'contraste_luminancia')}
FROM ({DIMENSION}) GROUP BY 1, 2, 3, 4"""

# ── log events ───────────────────────────────────────────────────────────────────

_MS = ("unix_millis(CAST(ts AS TIMESTAMP))", "(epoch_us(ts) // 1000)")
_K = "regexp_extract(props, '([0-9]+)', 1)"

LOG_COLUMNS: list[tuple[Expression, str]] = [
    ("event_type", "log_group"),
    ("concat('user-', CAST(user_id % 16 AS STRING))", "log_stream"),
    (_MS, "timestamp"),
    (
        "concat('{\"level\":\"', event_type, '\",\"params\":{\"job_id\":', CAST(user_id AS STRING),"
        " '},\"count\":', " + _K + ", CASE WHEN event_id % 6 = 0 THEN '' ELSE"
        " concat(',\"zone\":\"z', CAST(event_id % 3 AS STRING), '\"') END, '}')",
        "message",
    ),
    (f"(({_MS[0]} div 60000) + 1) * 60000", "ingestion_time"),
    ("event_id", "sequence"),
    ("concat('e', lpad(CAST(event_id AS STRING), 12, '0'))", "event_id"),
]
LOG_COLUMNS[4] = ((LOG_COLUMNS[4][0], f"(({_MS[1]} // 60000) + 1) * 60000"), "ingestion_time")


def logs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*spark_columns(LOG_COLUMNS))


LOGS = duck_select(
    [
        *LOG_COLUMNS,
        # the fields of the message, for the SQL twins
        ("event_type", "f_level"),
        ("CAST(user_id AS STRING)", "f_job"),
        (_K, "f_count"),
        ("CASE WHEN event_id % 6 = 0 THEN NULL ELSE concat('z', CAST(event_id % 3 AS STRING)) END", "f_zone"),
        ("strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g')", "f_time"),
    ],
    "events",
)

# ── metric data ──────────────────────────────────────────────────────────────────

METRIC_COLUMNS: list[tuple[Expression, str]] = [
    ("'app'", "namespace"),
    ("event_type", "metric"),
    (("map('shard', CAST(user_id % 4 AS STRING))", "concat('shard=', CAST(user_id % 4 AS STRING))"), "dimensions"),
    (("unix_seconds(CAST(ts AS TIMESTAMP))", "CAST(floor(epoch(ts)) AS BIGINT)"), "ts"),
    ("value", "value"),
    # one datum in ten is a statistic set
    ("CASE WHEN event_id % 10 = 0 THEN CAST(5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END", "sample_count"),
    ("CASE WHEN event_id % 10 = 0 THEN value * 4 ELSE CAST(0 AS DOUBLE) END", "sum"),
    ("CASE WHEN event_id % 10 = 0 THEN value / 2 ELSE CAST(0 AS DOUBLE) END", "minimum"),
    ("CASE WHEN event_id % 10 = 0 THEN value * 2 ELSE CAST(0 AS DOUBLE) END", "maximum"),
    ("CASE event_id % 3 WHEN 0 THEN 'Count' WHEN 1 THEN '' ELSE NULL END", "unit"),
]


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*spark_columns(METRIC_COLUMNS))


METRICS = f"""
SELECT namespace, metric, dimensions, ts, unit,
       CASE WHEN sample_count = 0 AND sum = 0 THEN 1.0 ELSE sample_count END AS sample_count,
       CASE WHEN sample_count = 0 AND sum = 0 THEN value ELSE sum END AS sum,
       CASE WHEN sample_count = 0 AND sum = 0 THEN value ELSE minimum END AS minimum,
       CASE WHEN sample_count = 0 AND sum = 0 THEN value ELSE maximum END AS maximum
FROM ({duck_select(METRIC_COLUMNS, 'events')})"""

# ── usage lines and rates ────────────────────────────────────────────────────────

_SERVICES = "CASE {} % 5 WHEN 0 THEN 'AmazonEC2' WHEN 1 THEN 'AmazonS3' WHEN 2 THEN 'AWSLambda' WHEN 3 THEN 'AmazonRDS' ELSE 'AmazonSNS' END"
_REGIONS = "CASE {} % 3 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'eu-west-1' ELSE 'sa-east-1' END"

USAGE_COLUMNS: list[tuple[Expression, str]] = [
    (("CAST(l_shipdate AS TIMESTAMP) + INTERVAL 12 HOURS", "l_shipdate + INTERVAL 12 HOURS"), "period_start"),
    # two days, so shares of days and months are exact; some lines have no length
    (
        (
            "CAST(l_shipdate AS TIMESTAMP) + INTERVAL 12 HOURS + CASE WHEN l_orderkey % 97 = 0 THEN INTERVAL 0 HOURS ELSE INTERVAL 48 HOURS END",
            "l_shipdate + INTERVAL 12 HOURS + CASE WHEN l_orderkey % 97 = 0 THEN INTERVAL 0 HOURS ELSE INTERVAL 48 HOURS END",
        ),
        "period_end",
    ),
    (_SERVICES.format("l_suppkey"), "service"),
    (_REGIONS.format("l_suppkey"), "region"),
    ("concat('U', CAST(l_partkey % 4 AS STRING))", "usage_type"),
    ("concat('do-', l_returnflag)", "operation"),
    ("CASE l_linenumber WHEN 7 THEN 'Tax' WHEN 6 THEN 'Refund' ELSE 'Usage' END", "record_type"),
    ("concat('acct-', l_linestatus)", "account"),
    ("concat('res-', CAST(l_partkey AS STRING))", "resource"),
    (
        (
            "CASE WHEN l_orderkey % 3 = 0 THEN CAST(map() AS MAP<STRING,STRING>) ELSE map('team', l_returnflag, 'env', concat('e', CAST(l_linenumber % 2 AS STRING))) END",
            "CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_returnflag END",
        ),
        "tags",
    ),
    ("l_quantity", "quantity"),
    ("'Hrs'", "usage_unit"),
]

RATE_COLUMNS: list[tuple[Expression, str]] = [
    (_SERVICES.format("p_partkey"), "service"),
    (_REGIONS.format("p_partkey"), "region"),
    ("concat('U', CAST(p_partkey % 4 AS STRING))", "usage_type"),
    # one kind of usage has no rate
    ("CASE WHEN p_partkey % 4 = 3 AND p_partkey % 3 = 2 THEN NULL ELSE CAST(p_size AS DOUBLE) / 400 END", "rate"),
]


def usage(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*spark_columns(USAGE_COLUMNS))


def rates(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(*spark_columns(RATE_COLUMNS))


USAGE = duck_select(
    [
        *USAGE_COLUMNS,
        ("CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE concat('e', CAST(l_linenumber % 2 AS STRING)) END", "env"),
        ("l_orderkey", "l_orderkey"),
        ("l_linenumber", "l_linenumber"),
    ],
    "lineitem",
)
RATES = duck_select(RATE_COLUMNS, "part")

PRICED = f"""
SELECT u.*, CASE WHEN u.record_type IN ('Credit', 'Refund', 'Tax', 'SavingsPlanUpfrontFee', 'SavingsPlanRecurringFee')
                 THEN u.quantity ELSE u.quantity * coalesce(r.rate, 0) END AS cost
FROM ({USAGE}) u LEFT JOIN (
    SELECT service, region, usage_type, max(rate) AS rate FROM ({RATES}) GROUP BY 1, 2, 3) r
  ON u.service = r.service AND u.region = r.region AND u.usage_type = r.usage_type"""

# ── bus events and messages ──────────────────────────────────────────────────────

_DETAIL = (
    "concat('{\"kind\":\"', event_type, '\",\"user\":', CAST(user_id AS STRING), ',\"k\":', " + _K + ","
    " CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN ',\"tag\":null'"
    " ELSE concat(',\"tag\":\"t', CAST(event_id % 7 AS STRING), '\"') END,"
    " ',\"info\":{\"flag\":', CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END, '},\"marks\":[',"
    " CASE WHEN event_id % 4 = 0 THEN '' ELSE concat('\"m', CAST(event_id % 4 AS STRING), '\",', " + _K + ") END,"
    " '],\"raw\":\"{\\\\\"n\\\\\":', " + _K + ", '}\"}')"
)

EVENT_COLUMNS: list[tuple[Expression, str]] = [
    ("event_id", "event_id"),
    (("CAST(ts AS TIMESTAMP)", "ts"), "event_time"),
    ("concat('shop.', event_type)", "source"),
    ("CASE WHEN user_id % 2 = 0 THEN 'Order Placed' ELSE 'Page Seen' END", "detail_type"),
    ("CAST(user_id % 3 AS STRING)", "account"),
    ("CASE WHEN user_id % 5 = 0 THEN 'eu-west-1' ELSE 'us-east-1' END", "region"),
    ("CASE WHEN user_id % 4 = 0 THEN 'audit' ELSE 'default' END", "bus"),
    (("array(concat('user/', CAST(user_id AS STRING)), concat('type/', event_type))", "user_id"), "resources"),
    (
        (_DETAIL, _DETAIL.replace("\\\\", "\\")),
        "detail",
    ),
]


def bus_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*spark_columns(EVENT_COLUMNS))


# what the JSON of an event holds, for the SQL twins
EVENTS = f"""
SELECT event_id, ts, user_id, event_type, concat('shop.', event_type) AS source,
       CASE WHEN user_id % 2 = 0 THEN 'Order Placed' ELSE 'Page Seen' END AS detail_type,
       CASE WHEN user_id % 4 = 0 THEN 'audit' ELSE 'default' END AS bus,
       CASE WHEN user_id % 5 = 0 THEN 'eu-west-1' ELSE 'us-east-1' END AS region,
       CAST({_K} AS INT) AS k,
       CASE WHEN event_id % 5 IN (0, 1) THEN NULL ELSE concat('t', CAST(event_id % 7 AS STRING)) END AS tag,
       event_id % 2 = 0 AS flag,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE concat('m', CAST(event_id % 4 AS STRING)) END AS mark
FROM events"""

# ── document items from customer ─────────────────────────────────────────────────

ITEM_COLUMNS: list[tuple[Expression, str]] = [
    ("c_custkey", "c_custkey"),
    (
        "concat('{\"id\":{\"N\":\"', CAST(c_custkey AS STRING), '\"},\"name\":{\"S\":\"', c_name,"
        " '\"},\"balance\":{\"N\":\"', CAST(c_acctbal AS STRING), '\"},\"vip\":{\"BOOL\":',"
        " CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END, '}',"
        " CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat(',\"segment\":{\"S\":\"', c_mktsegment, '\"}') END,"
        " ',\"tags\":{\"SS\":[\"n', CAST(c_nationkey AS STRING), '\",\"all\"]},\"levels\":{\"NS\":[\"',"
        " CAST(c_custkey % 5 AS STRING), '\",\"10.0\"]},\"home\":{\"M\":{\"nation\":{\"N\":\"',"
        " CAST(c_nationkey AS STRING), '\"}}},\"past\":{\"L\":[{\"N\":\"', CAST(c_custkey % 7 AS STRING),"
        " '\"},{\"S\":\"x\"}]}}')",
        "item",
    ),
]


def items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(*spark_columns(ITEM_COLUMNS))


# ── a query vector and a few more ────────────────────────────────────────────────

DIMENSION_COUNT = 64


def query_vector(n: int) -> list[float]:
    """Query number n: a saw-tooth with its own step, exact in single precision."""
    return [((i * (37 + 10 * n) + n) % 64 - 32) / 64 for i in range(DIMENSION_COUNT)]


def vector_literal(n: int) -> str:
    return "[" + ", ".join(f"CAST({x!r} AS DOUBLE)" for x in query_vector(n)) + "]"
