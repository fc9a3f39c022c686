"""The product CSV and its reproducible sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("masterCategory", T.StringType()),
        T.StructField("subCategory", T.StringType()),
        T.StructField("articleType", T.StringType()),
        T.StructField("baseColour", T.StringType()),
        T.StructField("season", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("usage", T.StringType()),
        T.StructField("productDisplayName", T.StringType()),
    ]
)

# Words a data-frame CSV reader takes as missing.
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_products_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = PRODUCT_SCHEMA,
    multi_line: bool = False,
) -> DataFrame:
    """Header CSV with an explicit schema.

    Rows with too many fields are skipped, rows with too few are padded with
    null, NA words become null. Every cell is read as text and cast afterwards,
    so a bad number is a null and never a bad row. Lines are counted before they are parsed: the fields
    of a line are the commas outside its quotes and one, long lines go and short ones get the commas
    they lack, so the parser sees lines of the right width only. The first line of each file is its header.
    ``multi_line`` allows line breaks inside quotes but makes files unsplittable: there the parser cuts
    the rows, and a row it finds too long or too short is counted by the text it keeps of it.
    """
    names = schema.fieldNames()
    if multi_line:
        return _multi_line(spark, path, names).select([_cell(f) for f in schema.fields])
    # no quotes and a separator that no line has: the reader takes the header away and leaves lines whole
    lines = spark.read.schema("value STRING").option("header", True).option("quote", "").option("sep", _NO_SEPARATOR).csv(path)
    lines = lines.where(F.trim("value") != "")
    commas = F.regexp_count(F.regexp_replace("value", _QUOTED, ""), F.lit(","))
    fitting = lines.withColumn("_commas", commas).where(F.col("_commas") < len(names))
    padded = F.concat("value", F.repeat(F.lit(","), F.lit(len(names) - 1) - F.col("_commas")))
    text_schema = ", ".join(f"`{n}` STRING" for n in names)
    cells = F.from_csv(padded, text_schema, {"escape": '"'})
    return fitting.select(cells.alias("_row")).select("_row.*").select([_cell(f) for f in schema.fields])


_NO_SEPARATOR = "\u0001\u0002\u0001"
_QUOTED = '"([^"]|"")*"'


def _multi_line(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Rows whose quoted cells may hold line breaks: one column more than the schema shows what is too long."""
    text_schema = ", ".join(f"`{n}` STRING" for n in [*names, "_overflow", "_corrupt"])
    rows = (
        spark.read.schema(text_schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("columnPruning", False)
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )
    unquoted = F.regexp_replace("_corrupt", _QUOTED, "")
    return rows.where(
        F.col("_corrupt").isNotNull()
        & F.col("_overflow").isNull()
        & (F.regexp_count(unquoted, F.lit(",")) < len(names))
    )


def _cell(field: T.StructField):
    text = F.col(f"`{field.name}`")
    value = F.when(~text.isin(NA_WORDS), text)
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        value = value.try_cast("double").try_cast(field.dataType)
    elif not isinstance(field.dataType, T.StringType):
        value = value.try_cast(field.dataType)
    return value.alias(field.name)


#: Rows of the sample that are ordered in one task at most.
FEW_ROWS = 100_000
_DIGITS = 3


def sample_products(df: DataFrame, n: int, seed: int = 42, key: str = "id", few: int = FEW_ROWS) -> DataFrame:
    """Exactly n rows (or all, if fewer), the same ones for the same seed.

    Rows are ranked by a hash of key and seed, so the choice does not depend on the file layout; equal keys
    fall back to a hash of the whole row. Nothing is sorted as a whole: a histogram of the leading
    digits finds the bucket in which the sample ends, and is refined there until that bucket has at most
    ``few`` rows. Buckets before it belong to the sample, and of its own rows the lowest ranks do.
    """
    if n <= 0:
        return df.limit(0)
    by_key = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    rank = F.concat(F.coalesce(by_key, F.lit("f" * 32)), F.lower(F.lpad(F.hex(F.xxhash64(*df.columns)), 16, "0")))
    ranked = df.select("*", rank.alias("_rank"))
    prefix, wanted, rest = "", n, ranked
    while True:
        digits = len(prefix) + _DIGITS
        counts = rest.groupBy(F.substring("_rank", 1, digits).alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()
        for p, size in counts:
            if size >= wanted:
                prefix = p
                break
            wanted -= size
        else:
            return df  # fewer rows than wanted: this can happen in the first round only
        rest = ranked.where(F.substring("_rank", 1, digits) == prefix)
        if size <= few or digits >= 48:
            break
    before = ranked.where(F.substring("_rank", 1, len(prefix)) < prefix)
    return before.unionByName(rest.orderBy("_rank").limit(wanted)).drop("_rank")


def keep_assets(assets: DataFrame, sample: DataFrame, key: str = "id") -> DataFrame:
    """Only the assets of sampled products."""
    return assets.join(sample.select(key), key, "left_semi")
