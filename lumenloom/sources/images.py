"""Product images and their colour and texture features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = [
    "mean_r", "mean_g", "mean_b", "std_r", "std_g", "std_b", "brightness",
    "saturacao_media", "complexidade_visual", "contraste_luminancia",
]

# Luminance weights of red, green and blue.
LUMINANCE = np.array([0.299, 0.587, 0.114])

FEATURE_SCHEMA = "id int, file_size_bytes int, " + ", ".join(f"{f} double" for f in FEATURES)


def read_images(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per image file: id from the file name, size in bytes, decoded pixels.

    Files that cannot be decoded stay, with width -1. The size comes from the
    file metadata of the same scan, so no file is read twice.
    """
    reader = spark.read.format("image").option("dropInvalid", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        F.regexp_extract("image.origin", r"(\d+)\.[A-Za-z]+$", 1).try_cast("int").alias("id"),
        F.col("_metadata.file_size").cast("int").alias("file_size_bytes"),
        "image.height",
        "image.width",
        "image.nChannels",
        "image.data",
    )


def pixel_features(data: bytes, height: int, width: int, channels: int) -> tuple[float, ...]:
    """The ten features of one image given as row-major B,G,R[,A] or gray bytes."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        rgb = np.repeat(pixels, 3, axis=2)
    else:
        rgb = pixels[:, :, 2::-1]
    flat = rgb.reshape(-1, 3).astype(np.float64)
    luminance = rgb @ LUMINANCE
    high = rgb.max(axis=2).astype(np.float32)
    spread = high - rgb.min(axis=2)
    # single-precision ratio, then truncated to a level, as HSV bytes are stored
    ratio = np.divide(spread, high, out=np.zeros_like(high), where=high > 0)
    saturation = np.floor(ratio.astype(np.float64) * 255.0)
    gradient = np.abs(np.diff(luminance, axis=1)).mean() if width > 1 else np.nan
    return (
        *flat.mean(axis=0),
        *flat.std(axis=0),
        luminance.mean(),
        saturation.mean(),
        gradient,
        luminance.std(),
    )


def _features_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            good = r.data is not None and r.width > 0 and r.height > 0
            values = pixel_features(r.data, r.height, r.width, r.nChannels) if good else None
            rows.append((r.id, r.file_size_bytes if good else None, *(values or [None] * 10)))
        out = pd.DataFrame(rows, columns=["id", "file_size_bytes", *FEATURES])
        out["file_size_bytes"] = out["file_size_bytes"].astype("Int32")
        out[FEATURES] = out[FEATURES].astype("float64")
        yield out


def image_features(images: DataFrame) -> DataFrame:
    """All eleven features per image; an undecodable image has none of them.

    NumPy works on whole images inside Arrow batches; the batch size in bytes is
    bounded by spark.sql.execution.arrow.maxBytesPerBatch.
    """
    inputs = images.select("id", "file_size_bytes", "height", "width", "nChannels", "data")
    # NumPy NaN marks "no value" here: no decoded image yields a true NaN feature
    out = inputs.where("id IS NOT NULL").mapInPandas(_features_of, FEATURE_SCHEMA)
    return out.select(
        "id", "file_size_bytes", *[F.when(~F.isnan(f), F.col(f)).alias(f) for f in FEATURES]
    )


def attach_features(products: DataFrame, features: DataFrame, key: str = "id") -> DataFrame:
    """Every product keeps its row; without a usable image its features are null."""
    return products.join(features, key, "left")
