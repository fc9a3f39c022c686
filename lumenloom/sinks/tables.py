"""Writing tables: idempotent reload, model materialisation and exports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenloom.functions.text import csv_line, json_line
from lumenloom.plans.medallion import MODELS
from lumenloom.sinks.line_files import write_lines


def load_raw(df: DataFrame, table: str) -> DataFrame:
    """Replace a catalogue table by ``df``.

    The rows are written to a folder of their own in the warehouse; then one change in the catalogue
    points the table there. A load that fails before that leaves the old rows in place, and readers
    of the old folder are not disturbed. Other columns or types need the table to be made anew, which
    takes two changes.
    """
    spark = df.sparkSession
    name = table.replace("`", "").replace(".", "-")
    place = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(place)
    if spark.catalog.tableExists(table):
        if spark.table(table).schema == spark.read.parquet(place).schema:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
            spark.catalog.refreshTable(table)
            return spark.table(table)
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{place}'")
    return spark.table(table)


def run_models(
    spark: SparkSession, raw: str = "products_raw", database: str | None = None, models=MODELS
) -> dict[str, DataFrame]:
    """Build every model as a table, inputs before the models that read them.

    Each model reads the saved tables of its inputs, so the dimension is computed
    once although two facts use it, and no lineage grows along the chain.
    """
    place = f"{database}." if database else ""
    built = {"products_raw": spark.table(raw)}
    for name, (inputs, build) in models.items():
        built[name] = load_raw(build(*[built[i] for i in inputs]), f"{place}{name}")
    return built


def write_result_csv(df: DataFrame, path: str) -> None:
    """A query result as CSV with a header in every file.

    The parts stay as parallel as the result is; every value is written as text.
    """
    texts = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]
    df.select(texts).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def to_lines(df: DataFrame, kind: str) -> DataFrame:
    """Rows as CSV lines (a null is an empty cell) or JSON lines (a null stays null)."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    if kind.upper() == "CSV":
        return df.select(csv_line(columns).alias("line"))
    if kind.upper() == "JSON":
        return df.select(json_line(columns).alias("line"))
    raise ValueError("kind must be CSV or JSON")


_MANIFEST = "file string, bytes bigint, md5 string, items bigint, raw_bytes bigint, raw_md5 string"


def export_snapshot(df: DataFrame, path: str, folder: Column | None = None, order: list[str] = (), columns: list[str] | None = None) -> DataFrame:
    """Gzip lines {"Item": ...} below path/data, and the manifest of what was written.

    The manifest is a DataFrame with one row per data file (file, bytes, md5, item_count and, before
    compression, raw_bytes and raw_md5) and one row "*" with the number of items in all; the rows of the files are
    also saved as JSON below path/manifest. Writers count and hash as they write. ``folder`` puts the
    rows of each of its values, in ``order``, into a folder of that name. Items have all columns, or ``columns``.
    """
    spark = df.sparkSession
    item = F.struct(*[F.col(f"`{c}`") for c in columns or df.columns])
    line = F.to_json(F.struct(item.alias("Item"))).alias("value")
    if folder is None:
        lines = df.select(F.lit("").alias("folder"), line)
    else:
        placed = df.withColumn("_folder", folder).repartition("_folder").sortWithinPartitions("_folder", *order)
        lines = placed.select(F.col("_folder").alias("folder"), line)
    write_lines(lines, f"{path}/data", ".json.gz", zipped=True, manifest=f"{path}/manifest")
    files = spark.read.schema(_MANIFEST).json(f"{path}/manifest").withColumnRenamed("items", "item_count")
    total = files.agg(F.lit("*").alias("file"), F.coalesce(F.sum("item_count"), F.lit(0)).alias("item_count"))
    return files.unionByName(total, allowMissingColumns=True)
