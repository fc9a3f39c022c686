"""Token counts as an exact histogram of encoded lengths, answered by suffix sums.

Documents are counted per encoded length; from the longest length down, sums give for every context
limit how many documents are at least that long and how many tokens a cut at the limit leaves. Totals
and quantiles are read from the same table.

Defined results: a null or empty text has length 0. Repeated rows count each. An empty table gives an
empty histogram. Columns besides the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumenloom.llm import textvec as tv
from lumenloom.llm.encoding import default_path, encoder
from lumenloom.llm.tables import written

#: Lengths that one window of the running sums holds.
BAND = 4096


def _lengths(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.slices(batch, "text", 4 << 20):
                _, lengths = encoder(path).encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_pydict({"length": pa.array(lengths, pa.int64())})

    return run


def histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """length and n_docs, the documents of exactly that many tokens."""
    lengths = docs.select("text").mapInArrow(_lengths(path or default_path()), "length long")
    return lengths.groupBy("length").agg(F.count("*").alias("n_docs"))


def answers(counted: DataFrame) -> DataFrame:
    """One row per length L of the histogram, for the context limit L.

    n_docs, docs_at_least (documents of L tokens or more), tokens_at_least (their tokens),
    truncated_tokens (all tokens if every document is cut after L) and share_up_to (documents of at
    most L tokens, of all: the length whose share first reaches q is the quantile q).
    """
    counted = written(counted, "histogram")  # read twice: the texts behind it are encoded once
    rows = counted.withColumn("band", F.floor(F.col("length") / BAND)).withColumn("tokens", F.col("length") * F.col("n_docs"))
    bands = rows.groupBy("band").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    # rows here are bands of lengths: as many as the longest text has, over the width of a band
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    bands = bands.select(
        "band",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("d").over(every).alias("d_all"),
        F.sum("t").over(every).alias("t_all"),
    )
    down = Window.partitionBy("band").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("d_in", F.sum("n_docs").over(down)).withColumn("t_in", F.sum("tokens").over(down)).join(bands, "band")
    at_least, held = F.col("d_in") + F.col("d_above"), F.col("t_in") + F.col("t_above")
    return rows.select(
        "length",
        "n_docs",
        at_least.alias("docs_at_least"),
        held.alias("tokens_at_least"),
        (F.col("t_all") - held + at_least * F.col("length")).alias("truncated_tokens"),
        ((F.col("d_all") - at_least + F.col("n_docs")) / F.col("d_all")).alias("share_up_to"),
    )


def at_limits(counted: DataFrame, limits: list[int]) -> DataFrame:
    """limit, docs_over (longer than it) and truncated_tokens for any limits, in the histogram or not."""
    over = [F.sum(F.when(F.col("length") > x, F.col("n_docs")).otherwise(0)) for x in limits]
    kept = [F.sum(F.least("length", F.lit(x)) * F.col("n_docs")) for x in limits]
    rows = [F.struct(F.lit(x).alias("limit"), F.coalesce(o, F.lit(0)).alias("docs_over"), F.coalesce(k, F.lit(0)).alias("truncated_tokens")) for x, o, k in zip(limits, over, kept)]
    return counted.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def quantiles(answered: DataFrame, shares: list[float]) -> DataFrame:
    """share and the smallest length that at least this share of the documents does not exceed."""
    rows = [F.struct(F.lit(s).alias("share"), F.min(F.when(F.col("share_up_to") >= s - 1e-12, F.col("length"))).alias("length")) for s in shares]
    return answered.agg(F.array(*rows).alias("r")).select(F.inline("r"))
