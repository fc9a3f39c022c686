"""Image features, on images that Spark derives from the vectors table."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lumenloom.queries.base import table
from lumenloom.queries.registry import query
from lumenloom.session import shared_dir, written
from lumenloom.sinks.line_files import place_of, qualified
from lumenloom.sources import images

SIDE = 8  # a vector has 64 values, one per pixel of a square

# level of a channel of pixel i: a fixed mix of the vector value
_LEVEL = "CAST(floor(abs(CAST({x} AS DOUBLE)) * {scale}) AS INT) % 256"
_SCALES = {"r": 1500, "g": 900, "b": 2100}


def _pixel_bytes(x):
    """B, G, R of one pixel as six hex digits."""
    parts = []
    for c in ("b", "g", "r"):
        level = F.floor(F.abs(x.cast("double")) * F.lit(_SCALES[c])).cast("int") % 256
        parts.append(F.lpad(F.hex(level.cast("bigint")), 2, "0"))
    return F.concat(*parts)


def decoded(spark, d):
    """Decoded images as the image source would give them; every 25th is undecodable."""
    data = F.unhex(F.array_join(F.transform("embedding", _pixel_bytes), ""))
    broken = F.col("vec_id") % 25 == 0
    return table(spark, d, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"),
        (F.col("vec_id") * 10).cast("int").alias("file_size_bytes"),
        F.when(broken, -1).otherwise(SIDE).alias("height"),
        F.when(broken, -1).otherwise(SIDE).alias("width"),
        F.when(broken, -1).otherwise(3).alias("nChannels"),
        F.when(~broken, data).alias("data"),
    )


_PIXELS = f"""
SELECT vec_id, i, {', '.join(f"CAST({_LEVEL.format(x='embedding[i]', scale=s)} AS DOUBLE) AS {c}" for c, s in _SCALES.items())}
FROM embeddings, (SELECT unnest(range(1, {SIDE * SIDE + 1})) AS i)"""

_LUM = "0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b"

_SHADED = f"""
SELECT *, {_LUM} AS lum,
       CASE WHEN greatest(r, g, b) = 0 THEN 0 ELSE floor(CAST(CAST(greatest(r, g, b) - least(r, g, b) AS FLOAT)
            / CAST(greatest(r, g, b) AS FLOAT) AS DOUBLE) * 255) END AS sat,
       CASE WHEN (i - 1) % {SIDE} > 0 THEN abs({_LUM} - lag({_LUM}) OVER (PARTITION BY vec_id ORDER BY i)) END AS step
FROM ({_PIXELS})"""


def _rounded(sql: str, name: str) -> str:
    return f"CASE WHEN {{bad}} THEN NULL ELSE CAST(round(CAST({sql} AS DECIMAL(38,10)), 6) AS DOUBLE) END AS {name}"


_FEATURE_SQL = ", ".join(
    [_rounded(f"avg({c})", f"mean_{c}") for c in "rgb"]
    + [_rounded(f"stddev_pop({c})", f"std_{c}") for c in "rgb"]
    + [
        _rounded("avg(lum)", "brightness"),
        _rounded("avg(sat)", "saturacao_media"),
        _rounded("avg(step)", "complexidade_visual"),
        _rounded("stddev_pop(lum)", "contraste_luminancia"),
    ]
)

FEATURES = (
    f"SELECT CAST(vec_id AS INTEGER) AS id, {_FEATURE_SQL} FROM ({_SHADED}) GROUP BY vec_id".replace(
        "{bad}", "vec_id % 25 = 0"
    )
)


def rounded(features):
    """Features to six places, so engines that sum in another order agree."""
    return features.select("id", *_six(images.FEATURES))


def _six(columns):
    return [F.round(F.col(f).cast("decimal(38,10)"), 6).cast("double").alias(f) for f in columns]


@query("image_channel_stats", FEATURES)
def image_channel_stats(spark, d):
    return rounded(images.image_features(decoded(spark, d)))


@query("luminance_gradient", f"SELECT id, complexidade_visual FROM ({FEATURES})")
def luminance_gradient(spark, d):
    return rounded(images.image_features(decoded(spark, d))).select("id", "complexidade_visual")


@query(
    "product_image_join",
    "SELECT CAST(p_partkey AS INTEGER) AS id, p_name, CAST(CASE WHEN f.mean_r IS NULL THEN NULL ELSE p_partkey * 10 END AS INTEGER)"
    f" AS file_size_bytes, f.mean_r, f.brightness FROM part LEFT JOIN ({FEATURES}) f ON f.id = p_partkey",
)
def product_image_join(spark, d):
    products = table(spark, d, "part").select(F.col("p_partkey").cast("int").alias("id"), "p_name")
    # rounded after the join: the images are read once
    joined = images.attach_features(products, images.image_features(decoded(spark, d)))
    return joined.select("id", "p_name", "file_size_bytes", *_six(["mean_r", "brightness"]))


# ── image files ──────────────────────────────────────────────────────────────────


def png(rgb: np.ndarray) -> bytes:
    """A PNG file of 8-bit gray (h, w, 1), RGB (h, w, 3) or RGBA (h, w, 4) pixels."""
    height, width, channels = rgb.shape

    def block(kind: bytes, body: bytes) -> bytes:
        crc = struct.pack(">I", zlib.crc32(kind + body))
        return struct.pack(">I", len(body)) + kind + body + crc

    colour = {1: 0, 3: 2, 4: 6}[channels]
    head = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    lines = b"".join(b"\x00" + row.tobytes() for row in rgb.astype(np.uint8))
    return b"\x89PNG\r\n\x1a\n" + block(b"IHDR", head) + block(b"IDAT", zlib.compress(lines)) + block(b"IEND", b"")


def _write_files(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = place_of(path)
        fs.create_dir(root, recursive=True)
        for pdf in batches:
            sizes = []
            for r in pdf.itertuples(index=False):
                if r.data is None:
                    body = b"no image"
                else:
                    body = png(np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, 3)[:, :, ::-1])
                # the whole file appears under its name at once, also when a task runs again
                with fs.open_output_stream(f"{root}/{r.id}.png") as out:
                    out.write(body)
                sizes.append(len(body))
            yield pd.DataFrame({"id": pdf["id"], "bytes": sizes})

    return run


@query("image_source", f"SELECT *, CASE WHEN mean_r IS NOT NULL THEN true END AS size_as_written FROM ({FEATURES})")
def image_source(spark, d):
    """Files written by the tasks into the shared folder, read back by the image source, with the sizes written."""
    path = shared_dir(spark, "images")
    sizes = written(decoded(spark, d).mapInPandas(_write_files(qualified(spark, path)), "id int, bytes int"), "image-sizes")
    features = images.image_features(images.read_images(spark, path, "*.png")).select("id", "file_size_bytes", *_six(images.FEATURES))
    as_written = (F.col("bytes") == F.col("file_size_bytes")).alias("size_as_written")
    return features.join(sizes, "id").select("id", *images.FEATURES, as_written)
