"""Loosely typed scans of CSV, JSON and Parquet files, and catalogue views over them."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenloom.functions import json_paths
from lumenloom.functions.booleans import bound


def scan_csv(
    spark: SparkSession, path: str, header: str = "NONE", width: int | None = None
) -> DataFrame:
    """CSV as text columns: named by the header (USE) or _1.._N (NONE, IGNORE).

    Only the first line is read ahead, to find the number of columns; ``width``
    avoids that and allows rows wider than the first. Empty cells are null.
    """
    header = header.upper()
    if header not in ("USE", "NONE", "IGNORE"):
        raise ValueError("header must be USE, NONE or IGNORE")
    reader = spark.read.option("header", header != "NONE").option("escape", '"')
    if width:
        reader = reader.schema(", ".join(f"_{i + 1} STRING" for i in range(width)))
    df = reader.csv(path)
    if header == "USE":
        return df
    return df.toDF(*[f"_{i + 1}" for i in range(len(df.columns))])


def scan_json(spark: SparkSession, path: str, schema=None, document: bool = False) -> DataFrame:
    """JSON lines (bad lines dropped), or one array or object per file (document).

    With a schema, typed columns; without one, a single VARIANT column ``row``,
    so no pass over the data is spent on guessing types.
    """
    if schema is not None:
        reader = spark.read.schema(schema).option("mode", "DROPMALFORMED")
        return reader.option("multiLine", document).json(path)
    text = spark.read.text(path, wholetext=document)
    value = json_paths.parse(F.col("value"))
    rows = text.select(value.alias("row")).where("row IS NOT NULL")
    if not document:
        return rows
    items = F.try_variant_get("row", "$", "array<variant>")
    return rows.select(F.explode(F.coalesce(items, F.array("row"))).alias("row"))


def scan_parquet(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge).parquet(path)


def scan_object(spark: SparkSession, path: str, content_type: str = "") -> DataFrame:
    """Pick the format by content type or suffix, Parquet first."""
    if "parquet" in content_type.lower() or path.lower().endswith(".parquet"):
        return scan_parquet(spark, path)
    if "json" in content_type.lower() or path.lower().endswith((".json", ".jsonl", ".ndjson")):
        return scan_json(spark, path)
    return scan_csv(spark, path, header="USE")


def format_of(serde: str | None, input_format: str | None = None) -> str:
    """Parquet if either name says so, then JSON (a Hive input format counts as JSON), else CSV."""
    reader, layout = (serde or "").lower(), (input_format or "").lower()
    if "parquet" in reader or "parquet" in layout:
        return "parquet"
    return "json" if "json" in reader or "json" in layout or "hive" in layout else "csv"


def register_catalog_views(spark: SparkSession, catalog: DataFrame) -> list[str]:
    """A view per catalogue row (table_name, location, serde and, if there are any,

    input_format and columns), over files at all depths. ``columns`` are the names and types of the
    table, such as "id INT, name STRING": with them no file is read before a query asks. Without them
    Parquet files are merged, JSON is read through and CSV is all text. The catalogue is table metadata, one
    small row per table."""
    names = []
    for row in catalog.toLocalIterator():
        has = lambda c: row[c] if c in catalog.columns else None  # noqa: B023, E731
        kind, columns = format_of(row["serde"], has("input_format")), has("columns")
        reader = spark.read.option("recursiveFileLookup", True)
        if columns:
            reader = reader.schema(columns)
        elif kind == "parquet":
            reader = reader.option("mergeSchema", True)
        if kind == "csv":
            reader = reader.option("header", True)
        reader.format(kind).load(row["location"]).createOrReplaceTempView(row["table_name"])
        names.append(row["table_name"])
    return names


def select_projection(df: DataFrame, columns: str | list[str]) -> DataFrame:
    """* or a list of names (any case) or positions _N; an unknown one is empty."""
    if columns == "*":
        return df
    if isinstance(columns, str):
        columns = [c.strip() for c in columns.split(",")]
    return df.select([resolve(df, c).alias(c) for c in columns])


def resolve(df: DataFrame, name: str):
    """A column by position _N or by name in any case; null when there is none."""
    by_name = {c.strip().lower(): c for c in df.columns}
    if name.lower() in by_name:
        return df[f"`{by_name[name.lower()]}`"]
    if name.startswith("_") and name[1:].isdigit() and 1 <= int(name[1:]) <= len(df.columns):
        return df[f"`{df.columns[int(name[1:]) - 1]}`"]
    return F.lit(None).cast("string")


def _child(step: str, node):
    """A member by its key or, for digits, an item by its index."""
    by_key = json_paths.at(node, [step])
    return F.coalesce(by_key, json_paths.at(node, [int(step)])) if step.isdigit() else by_key


def _entries(node):
    """(key, value) of what a value holds: array items without key, or members by key."""
    fields = F.try_variant_get(node, "$", "map<string,variant>")
    listed = F.transform(
        F.try_variant_get(node, "$", "array<variant>"),
        lambda x: F.struct(F.lit(None).cast("string").alias("key"), x.alias("value")),
    )
    keyed = F.transform(
        F.array_sort(F.map_keys(fields)),
        lambda k: F.struct(k.alias("key"), F.element_at(fields, k).alias("value")),
    )
    return F.coalesce(listed, keyed)


def explode_items(
    df: DataFrame, json: str, pointer: str = "", max_items: int | None = None
) -> DataFrame:
    """Items of the array, or (Key, Value) entries of the object, at a JSON pointer.

    Adds ``index``, ``key`` (null for arrays) and ``value`` (VARIANT). Entries of
    an object come in key order. A pointer that hits nothing iterable gives no row.
    """
    steps = [p.replace("~1", "/").replace("~0", "~") for p in pointer.split("/")[1:]]
    node = json_paths.parse(F.col(json))
    for step in steps:
        node = bound(node, partial(_child, step))
    items = bound(node, _entries)
    if max_items:
        items = F.slice(items, 1, max_items)
    out = df.select("*", F.posexplode(items).alias("index", "item"))
    return out.select(*df.columns, "index", "item.key", "item.value")
