"""The bronze, silver and gold models, each a function from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenloom.functions.numbers import round_decimal
from lumenloom.functions.text import clean_upper

# Source column -> bronze column, in the order of the bronze table.
BRONZE_NAMES = {
    "id": "ID",
    "gender": "GENDER",
    "masterCategory": "MASTER_CATEGORY",
    "subCategory": "SUB_CATEGORY",
    "articleType": "ARTICLE_TYPE",
    "baseColour": "BASE_COLOUR",
    "season": "SEASON",
    "year": "YEAR",
    "usage": "USAGE",
    "productDisplayName": "PRODUCT_DISPLAY_NAME",
    "mean_r": "MEAN_R",
    "mean_g": "MEAN_G",
    "mean_b": "MEAN_B",
    "std_r": "STD_R",
    "std_g": "STD_G",
    "std_b": "STD_B",
    "brightness": "BRIGHTNESS",
    "file_size_bytes": "FILE_SIZE_BYTES",
    "saturacao_media": "SATURACAO_MEDIA",
    "complexidade_visual": "COMPLEXIDADE_VISUAL",
    "contraste_luminancia": "CONTRASTE_LUMINANCIA",
}

# Silver column -> dimension column, in the order of the dimension.
DIMENSION_NAMES = {
    "id": "produto_id",
    "gender": "genero",
    "master_category": "categoria_principal",
    "sub_category": "subcategoria",
    "article_type": "tipo_artigo",
    "base_colour": "cor_base",
    "season": "estacao",
    "year": "ano_lancamento",
    "usage": "ocasiao_uso",
    "product_display_name": "nome_produto",
    "mean_r": "media_vermelho",
    "mean_g": "media_verde",
    "mean_b": "media_azul",
    "std_r": "desvio_vermelho",
    "std_g": "desvio_verde",
    "std_b": "desvio_azul",
    "brightness": "brilho",
    "is_multicolored": "multicolorido",
    "saturacao_media": "saturacao_media",
    "complexidade_visual": "complexidade_visual",
    "contraste_luminancia": "contraste_luminancia",
}

UPPER_COLUMNS = [
    "gender", "master_category", "sub_category", "article_type",
    "base_colour", "season", "usage",
]
PIXEL_COLUMNS = [
    "mean_r", "mean_g", "mean_b", "file_size_bytes", "brightness", "std_r", "std_g", "std_b",
    "saturacao_media", "complexidade_visual", "contraste_luminancia",
]
LABEL_COLUMNS = [
    "produto_id", "genero", "subcategoria", "tipo_artigo", "cor_base", "estacao", "ocasiao_uso",
]
SCALED_COLUMNS = [
    "media_vermelho", "media_verde", "media_azul", "brilho",
    "saturacao_media", "contraste_luminancia", "complexidade_visual",
]

# Reporting column -> averaged dimension column.
REPORT_AVERAGES = {
    "avg_vermelho": "media_vermelho",
    "avg_verde": "media_verde",
    "avg_azul": "media_azul",
    "avg_desvio_vermelho": "desvio_vermelho",
    "avg_desvio_verde": "desvio_verde",
    "avg_desvio_azul": "desvio_azul",
    "avg_brilho": "brilho",
    "avg_saturacao": "saturacao_media",
    "avg_complexidade_visual": "complexidade_visual",
    "avg_contraste_luminancia": "contraste_luminancia",
}
REPORT_KEYS = ["categoria_principal", "subcategoria", "genero", "estacao"]

MULTICOLOUR_STD = 45  # fixed value: mean channel deviation above which a product is patterned
CHANNEL_MAX = 255.0  # fixed value: largest channel level
MIN_CLASS_ROWS = 10  # fixed value: rows a target class needs


def to_bronze(df: DataFrame) -> DataFrame:
    """Rename to the bronze columns and put them in table order."""
    return df.withColumnsRenamed(BRONZE_NAMES).select(*BRONZE_NAMES.values())


def multicolored():
    spread = (F.col("std_r") + F.col("std_g") + F.col("std_b")) / 3
    return F.when(spread > MULTICOLOUR_STD, True).otherwise(False)


def clean_products(bronze: DataFrame) -> DataFrame:
    """Silver: trimmed, upper-cased labels and the pattern flag."""
    df = bronze.toDF(*[c.lower() for c in bronze.columns])
    upper = {c: clean_upper(F.col(c)).alias(c) for c in UPPER_COLUMNS}
    return df.select(
        "id",
        *[upper[c] for c in UPPER_COLUMNS[:6]],
        "year",
        upper["usage"],
        F.trim("product_display_name").alias("product_display_name"),
        *PIXEL_COLUMNS,
        multicolored().alias("is_multicolored"),
    )


def product_dim(silver: DataFrame) -> DataFrame:
    """Gold dimension: renamed columns of all products that have an id."""
    return silver.where("id IS NOT NULL").select(
        [F.col(old).alias(new) for old, new in DIMENSION_NAMES.items()]
    )


def frequent(df: DataFrame, column: str, n: int = MIN_CLASS_ROWS) -> DataFrame:
    """Values (a missing one is no class) that occur at least n times, with their count."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count("*").alias("rows")).where(F.col("rows") >= n)


def keep_frequent(df: DataFrame, column: str, n: int = MIN_CLASS_ROWS) -> DataFrame:
    """Rows of the frequent classes. No join hint: the optimiser broadcasts the

    class list only while it is small, and splits hot classes otherwise."""
    return df.join(frequent(df, column, n).select(column), column, "left_semi")


def ml_dataset(dim: DataFrame, n: int = MIN_CLASS_ROWS) -> DataFrame:
    """Gold: labels, features scaled to 0..1 and the target, rare classes removed."""
    # pruned first, so the shuffle carries only what the table needs
    base = dim.select(*LABEL_COLUMNS, *SCALED_COLUMNS, "categoria_principal")
    kept = keep_frequent(base, "categoria_principal", n)
    return kept.select(
        *LABEL_COLUMNS,
        *[scaled(F.col(c)).alias(f"{c}_norm") for c in SCALED_COLUMNS],
        F.col("categoria_principal").alias("target_categoria_principal"),
    )


def scaled(c):
    return round_decimal(c / CHANNEL_MAX, 4)


def pct_flagged(flag, counted):
    hits = F.sum(F.when(flag, 1).otherwise(0))
    return round_decimal(F.lit(100.0) * hits / F.count(counted), 2)


def color_metrics(dim: DataFrame) -> DataFrame:
    """Gold report: counts and rounded averages per category, subcategory, gender, season."""
    averages = {
        name: round_decimal(F.avg(source), 2).alias(name)
        for name, source in REPORT_AVERAGES.items()
    }
    order = list(averages)
    return dim.groupBy(*REPORT_KEYS).agg(
        F.count("produto_id").alias("total_produtos"),
        *[averages[n] for n in order[:6]],
        pct_flagged(F.col("multicolorido"), "produto_id").alias("pct_multicolorido"),
        *[averages[n] for n in order[6:]],
    )


def class_counts(ml: DataFrame) -> DataFrame:
    """Rows per target class, most first."""
    counts = ml.groupBy("target_categoria_principal").agg(F.count("*").alias("quantidade"))
    return counts.orderBy(F.desc("quantidade"), "target_categoria_principal")


def bi_summary(report: DataFrame) -> DataFrame:
    """The report by number of products; the group keys break ties."""
    return report.select(
        *REPORT_KEYS,
        "total_produtos",
        "avg_vermelho",
        "avg_verde",
        "avg_azul",
        "pct_multicolorido",
    ).orderBy(F.desc("total_produtos"), *REPORT_KEYS)


def load_report(bronze: DataFrame) -> DataFrame:
    """Rows loaded, and rows whose image gave no features."""
    return bronze.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("MEAN_R").isNull()).alias("failed_images"),
    )


def table_counts(**tables: DataFrame) -> DataFrame:
    """One labelled row count per table."""
    parts = [
        df.agg(F.count("*").alias("total")).select(F.lit(name).alias("tabela"), "total")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def preview(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first n rows in key order."""
    return df.orderBy(*keys).limit(n)


# table name -> (inputs, builder), in the order they must be built
MODELS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "stg_products": (("products_raw",), clean_products),
    "dim_produtos_analytics": (("stg_products",), product_dim),
    "fct_preparacao_ml": (("dim_produtos_analytics",), ml_dataset),
    "fct_metricas_cores_bi": (("dim_produtos_analytics",), color_metrics),
}
