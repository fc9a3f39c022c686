"""Reading part of an ordered record log or of an object listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_from(
    df: DataFrame,
    start: str,
    value=None,
    limit: int | None = None,
    seq: str = "sequence_number",
    arrival: str = "arrival",
) -> DataFrame:
    """A shard from a position on, in sequence order; one page of it if there is a limit.

    ``start``: OLDEST, NEWEST (nothing yet), AT_SEQUENCE, AFTER_SEQUENCE or
    AT_TIMESTAMP. The position is a range predicate, so it reaches the scan.
    """
    if start == "OLDEST":
        chosen = df
    elif start == "NEWEST":
        chosen = df.where(F.lit(False))
    elif start == "AT_SEQUENCE":
        chosen = df.where(F.col(seq) >= F.lit(value))
    elif start == "AFTER_SEQUENCE":
        chosen = df.where(F.col(seq) > F.lit(value))
    elif start == "AT_TIMESTAMP":
        # records arrive in sequence order, so this is where the log passes the time
        chosen = df.where(F.col(arrival) >= F.lit(value))
    else:
        raise ValueError(f"unknown start {start!r}")
    chosen = chosen.orderBy(seq)
    return chosen if limit is None else chosen.limit(limit)


def read_lag(
    df: DataFrame, page: DataFrame, seq: str = "sequence_number", arrival: str = "arrival"
) -> DataFrame:
    """Milliseconds between the last record of a page and the tip; 0 when caught up."""
    tip = df.agg(F.max_by(arrival, seq).alias("tip")).select("tip", F.lit(None).alias("seen"))
    seen = page.agg(F.max_by(arrival, seq).alias("seen")).select(F.lit(None).alias("tip"), "seen")
    both = tip.unionByName(seen).agg(F.max("tip").alias("tip"), F.max("seen").alias("seen"))
    gap = F.unix_millis(F.col("tip").cast("timestamp")) - F.unix_millis(
        F.col("seen").cast("timestamp")
    )
    return both.select(F.greatest(F.coalesce(gap, F.lit(0)), F.lit(0)).alias("millis_behind"))


def list_prefixes(
    df: DataFrame,
    prefix: str = "",
    delimiter: str | None = "/",
    max_keys: int | None = None,
    after: str | None = None,
    key: str = "key",
) -> DataFrame:
    """Listing below a prefix: objects, and what lies deeper as distinct common prefixes.

    Returns (entry, is_prefix) in text order, both kinds counting towards max_keys if given.
    """
    k = F.col(key)
    below = df.where(k.startswith(prefix)) if prefix else df
    if delimiter:
        cut = F.locate(delimiter, k, len(prefix) + 1)
        entry = F.when(cut > 0, F.substring(k, F.lit(1), cut + len(delimiter) - 1)).otherwise(k)
        rows = below.select(entry.alias("entry"), (cut > 0).alias("is_prefix"))
        groups = rows.where("is_prefix").distinct()
        rows = rows.where("NOT is_prefix").unionByName(groups)
    else:
        rows = below.select(k.alias("entry"), F.lit(False).alias("is_prefix"))
    if after is not None:
        rows = rows.where(F.col("entry") > after)
    return rows if max_keys is None else rows.orderBy("entry", "is_prefix").limit(max_keys)
