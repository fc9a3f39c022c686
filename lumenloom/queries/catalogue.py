"""Product catalogue: sources, models, data tests and table sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenloom.operators import quality
from lumenloom.plans import medallion as m
from lumenloom.queries.base import (
    DIMENSION,
    ML,
    RAW,
    REPORT,
    SILVER,
    products,
    table,
)
from lumenloom.queries.registry import query
from lumenloom.session import shared_dir
from lumenloom.sinks import tables
from lumenloom.sources import files
from lumenloom.sources import products as src


def _dim(spark, d):
    return m.product_dim(m.clean_products(products(spark, d)))


# ── models ───────────────────────────────────────────────────────────────────────


@query("color_metrics", REPORT)
def color_metrics(spark, d):
    return m.color_metrics(_dim(spark, d))


@query(
    "pct_flagged",
    f"SELECT categoria_principal, CAST(round(CAST(100.0 * sum(CASE WHEN multicolorido THEN 1 ELSE 0 END)"
    f" / count(produto_id) AS DECIMAL(38,10)), 2) AS DOUBLE) AS pct_multicolorido FROM ({DIMENSION}) GROUP BY 1",
)
def pct_flagged(spark, d):
    pct = m.pct_flagged(F.col("multicolorido"), "produto_id").alias("pct_multicolorido")
    return _dim(spark, d).groupBy("categoria_principal").agg(pct)


@query("normalize_text", SILVER)
def normalize_text(spark, d):
    return m.clean_products(products(spark, d))


@query(
    "multicolor_flag",
    f"SELECT is_multicolored, count(*) AS n, count(std_r) AS with_deviation FROM ({SILVER}) GROUP BY 1",
)
def multicolor_flag(spark, d):
    silver = m.clean_products(products(spark, d))
    return silver.groupBy("is_multicolored").agg(
        F.count("*").alias("n"), F.count("std_r").alias("with_deviation")
    )


@query("product_dimension", DIMENSION)
def product_dimension(spark, d):
    return _dim(spark, d)


@query("scale_features", ML)
def scale_features(spark, d):
    return m.ml_dataset(_dim(spark, d))


@query(
    "frequent_class_semijoin",
    f"SELECT produto_id, categoria_principal FROM ({DIMENSION}) WHERE categoria_principal IN"
    f" (SELECT categoria_principal FROM ({DIMENSION}) GROUP BY 1 HAVING count(*) >= 10)",
)
def frequent_class_semijoin(spark, d):
    base = _dim(spark, d).select("produto_id", "categoria_principal")
    return m.keep_frequent(base, "categoria_principal", 10)


@query(
    "having_min_count",
    f"SELECT categoria_principal, count(*) AS rows FROM ({DIMENSION}) WHERE categoria_principal IS NOT NULL"
    " GROUP BY 1 HAVING count(*) >= 10",
)
def having_min_count(spark, d):
    return m.frequent(_dim(spark, d), "categoria_principal", 10)


@query(
    "class_distribution",
    f"SELECT target_categoria_principal, count(*) AS quantidade FROM ({ML}) GROUP BY 1",
)
def class_distribution(spark, d):
    return m.class_counts(m.ml_dataset(_dim(spark, d)))


@query(
    "metrics_by_volume",
    "SELECT categoria_principal, subcategoria, genero, estacao, total_produtos, avg_vermelho, avg_verde,"
    f" avg_azul, pct_multicolorido FROM ({REPORT})",
)
def metrics_by_volume(spark, d):
    return m.bi_summary(m.color_metrics(_dim(spark, d)))


@query(
    "load_failure_count",
    f"SELECT count(*) AS total_rows, count(*) FILTER (WHERE STD_R IS NULL) AS failed_images FROM ({RAW})",
)
def load_failure_count(spark, d):
    # in the stand-in a failed image shows in the deviations
    raw = products(spark, d)
    return m.load_report(raw.withColumn("MEAN_R", F.when(F.col("STD_R").isNotNull(), F.col("MEAN_R"))))


@query("preview_limit", f"SELECT * FROM ({RAW}) ORDER BY ID LIMIT 10")
def preview_limit(spark, d):
    return m.preview(products(spark, d), 10, "ID")


@query(
    "table_counts_union",
    f"SELECT 'DIM_PRODUTOS_ANALYTICS' AS tabela, count(*) AS total FROM ({DIMENSION}) UNION ALL"
    f" SELECT 'FCT_PREPARACAO_ML', count(*) FROM ({ML}) UNION ALL"
    f" SELECT 'FCT_METRICAS_CORES_BI', count(*) FROM ({REPORT})",
)
def table_counts_union(spark, d):
    dim = _dim(spark, d)
    return m.table_counts(
        DIM_PRODUTOS_ANALYTICS=dim,
        FCT_PREPARACAO_ML=m.ml_dataset(dim),
        FCT_METRICAS_CORES_BI=m.color_metrics(dim),
    )


_CAMEL = {v: k for k, v in m.BRONZE_NAMES.items()}


@query("rename_to_bronze", RAW)
def rename_to_bronze(spark, d):
    return m.to_bronze(products(spark, d).withColumnsRenamed(_CAMEL))


# ── sources ──────────────────────────────────────────────────────────────────────


def _csv_lines(spark, d):
    """The products as CSV text: good rows, short, long and trailing-comma rows, NA words."""
    p = products(spark, d)
    quoted = F.concat(F.lit('"'), F.trim("PRODUCT_DISPLAY_NAME"), F.lit(', new"'))
    usage = F.when(F.col("ID") % 11 == 0, "NA").otherwise(F.col("USAGE"))
    cells = [
        F.col(c).cast("string")
        for c in ("ID", "GENDER", "MASTER_CATEGORY", "SUB_CATEGORY", "ARTICLE_TYPE", "BASE_COLOUR", "SEASON", "YEAR")
    ]
    full = F.concat_ws(",", *cells, usage, quoted)
    line = (
        F.when(F.col("ID") % 17 == 0, F.concat(full, F.lit(",extra")))
        .when(F.col("ID") % 19 == 0, F.concat(full, F.lit(",")))
        .when(F.col("ID") % 23 == 0, F.concat(full, F.lit(",,two")))
        .when(F.col("ID") % 29 == 0, F.concat_ws(",", *cells[:4]))
        .otherwise(full)
    )
    header = ",".join(src.PRODUCT_SCHEMA.fieldNames())
    return p.select(line.alias("value")), header


def _written_csv(spark, d):
    """Header and rows as separate files: every file of a CSV folder starts with the header."""
    lines, header = _csv_lines(spark, d)
    path = shared_dir(spark, "products-csv")
    names = header.split(",")
    # the text writer has no header, so the rows go through the CSV writer unquoted
    lines.select(F.col("value").alias(header)).write.option("header", True).option("quote", "\u0000").option(
        "sep", "\u0001"
    ).csv(path)
    assert len(names) == 10
    return path


_LONG = "(ID % 17 = 0 OR ID % 19 = 0 OR ID % 23 = 0)"


def _cell(c: str) -> str:
    return f"CASE WHEN ID % 29 = 0 THEN NULL ELSE {c} END"


@query(
    "csv_source",
    f"SELECT ID AS id, GENDER AS gender, MASTER_CATEGORY AS masterCategory, SUB_CATEGORY AS subCategory,"
    f" {_cell('ARTICLE_TYPE')} AS articleType, {_cell('BASE_COLOUR')} AS baseColour, {_cell('SEASON')} AS season,"
    f" {_cell('YEAR')} AS year, CASE WHEN ID % 29 = 0 OR ID % 11 = 0 THEN NULL ELSE USAGE END AS usage,"
    f" {_cell('concat(trim(PRODUCT_DISPLAY_NAME), chr(44), chr(32), chr(110), chr(101), chr(119))')} AS productDisplayName"
    f" FROM ({RAW}) WHERE NOT {_LONG}",
)
def csv_source(spark, d):
    return src.read_products_csv(spark, _written_csv(spark, d))


@query(
    "reproducible_sample",
    f"SELECT ID, MASTER_CATEGORY FROM ({RAW}) ORDER BY md5(concat(CAST(ID AS VARCHAR), '|42')), ID LIMIT 1000",
)
def reproducible_sample(spark, d):
    picked = products(spark, d).select("ID", "MASTER_CATEGORY")
    return src.sample_products(picked, 1000, 42, key="ID")


@query(
    "sample_asset_semijoin",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part"
    " ORDER BY md5(concat(CAST(p_partkey AS VARCHAR), '|7')), p_partkey LIMIT 200)",
)
def sample_asset_semijoin(spark, d):
    parts = table(spark, d, "part").select("p_partkey")
    chosen = src.sample_products(parts, 200, 7, key="p_partkey").withColumnRenamed("p_partkey", "l_partkey")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return src.keep_assets(lines, chosen, "l_partkey")


@query(
    "parquet_scan",
    "SELECT p_brand, count(*) AS n, max(p_size) AS largest FROM part WHERE p_size >= 20 GROUP BY 1",
)
def parquet_scan(spark, d):
    part = files.scan_object(spark, f"{d}/part.parquet")
    return part.where("p_size >= 20").groupBy("p_brand").agg(
        F.count("*").alias("n"), F.max("p_size").alias("largest")
    )


@query(
    "positional_csv_scan",
    "SELECT CAST(n_nationkey AS VARCHAR) AS _1, n_name AS _2, c_mktsegment AS _3, CAST(c_custkey AS VARCHAR) AS _4"
    " FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def positional_csv_scan(spark, d):
    path = shared_dir(spark, "positional-csv")
    rows = table(spark, d, "customer").join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    rows.select("n_nationkey", "n_name", "c_mktsegment", "c_custkey").write.csv(path)
    return files.scan_csv(spark, path, header="NONE")


@query(
    "json_scan",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 50 <> 3",
)
def json_scan(spark, d):
    path = shared_dir(spark, "json-lines")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    text = F.to_json(F.struct(*orders.columns))
    # some lines are broken and must be dropped
    orders.select(F.when(F.col("o_orderkey") % 50 == 3, "{broken").otherwise(text).alias("value")).write.text(path)
    return files.scan_json(spark, path, orders.schema)


@query(
    "catalog_table_scan",
    "SELECT n_name, count(*) AS customers, sum(o.n) AS orders FROM customer c JOIN nation ON c_nationkey = n_nationkey"
    " JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o.o_custkey = c_custkey GROUP BY 1",
)
def catalog_table_scan(spark, d):
    base = shared_dir(spark, "catalogue")
    nation = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table(spark, d, "nation").schema)
    table(spark, d, "customer").write.parquet(f"{base}/customer/deep/er")
    table(spark, d, "nation").write.option("header", True).csv(f"{base}/nation")
    table(spark, d, "orders").select("o_orderkey", "o_custkey").write.json(f"{base}/orders")
    catalog = spark.createDataFrame(
        [
            ("cat_customer", f"{base}/customer", "ParquetHiveSerDe", "c_custkey BIGINT, c_nationkey INT"),
            ("cat_nation", f"{base}/nation", "OpenCSVSerde", nation),
            ("cat_orders", f"{base}/orders", "JsonSerDe", "o_custkey BIGINT"),
        ],
        "table_name string, location string, serde string, columns string",
    )
    files.register_catalog_views(spark, catalog)
    return spark.sql(
        "SELECT n_name, count(*) AS customers, sum(o.n) AS orders FROM cat_customer c"
        " JOIN cat_nation ON c_nationkey = CAST(n_nationkey AS INT)"
        " JOIN (SELECT o_custkey, count(*) AS n FROM cat_orders GROUP BY 1) o ON o.o_custkey = c_custkey GROUP BY 1"
    )


@query(
    "select_columns",
    "SELECT p_name AS P_NAME, p_brand AS _3, CAST(NULL AS VARCHAR) AS nothing FROM part",
)
def select_columns(spark, d):
    return files.select_projection(table(spark, d, "part"), "P_NAME, _3, nothing")


@query(
    "json_array_reader",
    "SELECT o_orderkey, CAST(i - 1 AS INTEGER) AS index, CASE i WHEN 1 THEN o_orderstatus ELSE o_orderpriority END AS value"
    " FROM orders, (SELECT unnest([1, 2]) AS i)",
)
def json_array_reader(spark, d):
    orders = table(spark, d, "orders")
    doc = F.to_json(
        F.struct(F.struct(F.array("o_orderstatus", "o_orderpriority", F.lit("cut off")).alias("list")).alias("in"))
    )
    out = files.explode_items(orders.select("o_orderkey", doc.alias("doc")), "doc", "/in/list", 2)
    return out.select("o_orderkey", "index", F.try_variant_get("value", "$", "string").alias("value"))


# ── sinks ────────────────────────────────────────────────────────────────────────


def _database(spark, name):
    """A database of this run below the shared folder."""
    place = shared_dir(spark, name)
    db = "run_" + place.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{place}'")
    return db


@query("table_overwrite", f"SELECT ID, MASTER_CATEGORY, MEAN_R FROM ({RAW})")
def table_overwrite(spark, d):
    db = _database(spark, "load")
    raw = products(spark, d).select("ID", "MASTER_CATEGORY", "MEAN_R")
    tables.load_raw(raw.where("ID % 2 = 0"), f"{db}.products_raw")
    return tables.load_raw(raw, f"{db}.products_raw")


@query("materialize_model", REPORT)
def materialize_model(spark, d):
    db = _database(spark, "models")
    tables.load_raw(products(spark, d), f"{db}.products_raw")
    return tables.run_models(spark, f"{db}.products_raw", db)["fct_metricas_cores_bi"]


@query(
    "result_csv_sink",
    "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(count(*) AS VARCHAR) AS customers"
    " FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2",
)
def result_csv_sink(spark, d):
    path = shared_dir(spark, "result-csv")
    joined = table(spark, d, "customer").join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    tables.write_result_csv(joined.groupBy("n_nationkey", "n_name").agg(F.count("*").alias("customers")), path)
    return files.scan_csv(spark, path, header="USE")


@query(
    "row_serializer",
    "SELECT concat(CAST(p_partkey AS VARCHAR), ',\"', p_name, ', \"\"new\"\"\",', CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END) AS line"
    " FROM part UNION ALL SELECT concat('{\"p_partkey\":', CAST(p_partkey AS VARCHAR), ',\"p_name\":\"', p_name,"
    " ', \\\"new\\\"\",\"brand\":', CASE WHEN p_size % 2 = 0 THEN concat('\"', p_brand, '\"') ELSE 'null' END, '}') FROM part",
)
def row_serializer(spark, d):
    part = table(spark, d, "part").select(
        "p_partkey",
        F.concat("p_name", F.lit(', "new"')).alias("p_name"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("brand"),
    )
    return tables.to_lines(part, "CSV").unionByName(tables.to_lines(part, "JSON"))


_ITEM = (
    "concat('{\"Item\":{\"c_custkey\":', c_custkey, ',\"c_name\":\"', c_name, '\",\"c_mktsegment\":\"', c_mktsegment,"
    " '\",\"c_acctbal\":', CAST(c_acctbal AS VARCHAR), '}}', chr(10))"
)


@query(
    "snapshot_export",
    f"SELECT concat('nation=', CAST(c_nationkey AS VARCHAR)) AS folder, count(*) AS items, CAST(sum(strlen(line)) AS BIGINT) AS raw_bytes,"
    f" md5(string_agg(line, '' ORDER BY c_custkey)) AS raw_md5, true AS as_told FROM (SELECT *, {_ITEM} AS line FROM customer) GROUP BY c_nationkey",
)
def snapshot_export(spark, d):
    """The manifest, and whether the files are as it says when they are read again."""
    path = shared_dir(spark, "snapshot")
    nation = F.concat(F.lit("nation="), F.col("c_nationkey").cast("string"))
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", nation.alias("nation"))
    items = customers.drop("nation")
    manifest = tables.export_snapshot(customers, path, F.col("nation"), ["c_custkey"], items.columns)
    found = spark.read.text(f"{path}/data").groupBy("nation").agg(F.sum(F.octet_length("value") + 1).alias("found"))
    told = manifest.where("file <> '*'").withColumn("folder", F.element_at(F.split("file", "/"), 1))
    both = told.join(found, F.col("folder") == F.concat(F.lit("nation="), F.col("nation").cast("string")))
    return both.select("folder", F.col("item_count").alias("items"), "raw_bytes", "raw_md5", (F.col("found") == F.col("raw_bytes")).alias("as_told"))


# ── data tests ───────────────────────────────────────────────────────────────────


@query(
    "check_unique",
    "SELECT l_orderkey, count(*) AS occurrences FROM lineitem GROUP BY 1 HAVING count(*) > 1",
)
def check_unique(spark, d):
    return quality.check_unique(table(spark, d, "lineitem"), "l_orderkey")


@query("check_not_null", f"SELECT ID, STD_R FROM ({RAW}) WHERE STD_R IS NULL")
def check_not_null(spark, d):
    return quality.check_not_null(products(spark, d).select("ID", "STD_R"), "STD_R")


def _duplicate(c):
    return f"(SELECT count(*) FROM (SELECT {c} FROM orders GROUP BY 1 HAVING count(*) > 1))"


_CHECKS = [
    ("stg_products", "id", "unique", f"(SELECT count(*) FROM (SELECT id FROM ({SILVER}) GROUP BY 1 HAVING count(*) > 1))"),
    ("stg_products", "std_r", "not_null", f"(SELECT count(*) FROM ({SILVER}) WHERE std_r IS NULL)"),
    ("stg_products", "master_category", "not_null", f"(SELECT count(*) FROM ({SILVER}) WHERE master_category IS NULL)"),
    ("orders", "o_custkey", "unique", _duplicate("o_custkey")),
    ("orders", "o_orderkey", "unique", _duplicate("o_orderkey")),
]


@query(
    "run_checks",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS check_name, {sql} AS failures"
        for t, c, k, sql in _CHECKS
    ),
)
def run_checks(spark, d):
    found = {"stg_products": m.clean_products(products(spark, d)), "orders": table(spark, d, "orders")}
    return quality.run_checks(found, [(t, c, k) for t, c, k, _ in _CHECKS])


def _stat(c: str, distinct: str) -> str:
    return (
        f"SELECT event_type, '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls,"
        f" CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max,"
        f" {distinct} AS distinct_close, CAST(NULL AS VARCHAR) AS error FROM events GROUP BY 1"
    )


@query(
    "column_statistics",
    _stat("user_id", "true")
    + " UNION ALL "
    + _stat("props", "true")
    + " UNION ALL SELECT event_type, 'gone', NULL, NULL, NULL, NULL, NULL, 'column not found' FROM events GROUP BY 1",
)
def column_statistics(spark, d):
    events = table(spark, d, "events")
    stats = quality.column_stats(events, ["user_id", "props", "gone"], by=["event_type"])
    # the exact distinct counts beside the approximate ones, which must be near
    exact = events.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("user_id"), F.count_distinct("props").alias("props")
    )
    true_count = F.when(F.col("column_name") == "user_id", F.col("user_id")).when(
        F.col("column_name") == "props", F.col("props")
    )
    close = F.abs(F.col("approx_distinct") - true_count) <= 0.15 * true_count
    return stats.join(exact, "event_type").select(
        "event_type", "column_name", "rows", "nulls", "min", "max", close.alias("distinct_close"), "error"
    )
