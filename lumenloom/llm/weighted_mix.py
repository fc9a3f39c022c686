"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations alone.

A source's target is its share of all words by weight, at most ``most`` times its size; what is over
goes to the other sources by weight until none is above. Whole multiples of the source's size are
complete epochs, in which every document is taken; the rest is a weighted sample without replacement:
documents in the order of -ln(u) / quality, u a hash of the id, up to the words still wanted.

The order within a source is never sorted in one place: keys map to slices of near equal count, sums
per slice are added up along the source, and only the slice where the target falls is ordered by row.
A document joins the sample if its middle lies before the target, so the taken words miss the target
by half a document at most.

Defined results: a null or empty text has size 0 and is taken as often as its place says. A null
source is a source of its own, last in order. Rows that share an id are told apart by their text;
exactly equal rows share a place in the order and are taken one by one. Extra columns, whatever their
names, are carried along by ``mixed`` and ignored by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumenloom.llm.tables import written

#: Documents in a slice, on average.
SLICE = 5_000
WEIGHTS = (5, 2, 1)
_SPACES = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; a null text has none."""
    edge = lambda at: F.substring(text, at, 1).rlike(_SPACES).cast("int")
    inner = F.size(F.split(text, _SPACES)) - edge(1) - edge(-1)
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(inner).cast("long")


def unit(doc_id: Column) -> Column:
    """A number in (0, 1) that depends on the id alone."""
    bits = F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 12), 16, 10).cast("double")
    return F.coalesce((bits + 0.5) / F.lit(float(1 << 48)), F.lit(0.5))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """One row per source of ``sizes`` (source, source_size, ...) with its target added.

    Sources fill up in the order of limit per weight. With the first k full, the rest reaches a level
    (words per weight) that rises with k as long as those k are rightly full and falls afterwards, so
    the highest level is the one. Rows here are sources, so one window over all is small.
    """
    every = Window.partitionBy(F.lit(0))
    place = F.row_number().over(every.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("_w", weight.cast("double")).withColumn("_limit", most * F.col("source_size"))
    by_limit = every.orderBy(F.col("_limit") / F.col("_w"), F.col("source").isNull(), "source")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("_total", F.sum("source_size").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    ranked = ranked.withColumn("_full", F.coalesce(F.sum("_limit").over(before), F.lit(0)))
    ranked = ranked.withColumn("_open", F.sum("_w").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
    level = (F.col("_total") - F.col("_full")) / F.col("_open")
    ranked = ranked.withColumn("_level", F.max(level).over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("_limit").cast("double"), F.col("_level") * F.col("_w"))
    return ranked.withColumn("target", target).drop("_w", "_limit", "_total", "_full", "_open", "_level")


def _keyed(docs: DataFrame, quality: DataFrame | None) -> DataFrame:
    """doc_id, source, size, the exponential key and a tie-break of every row."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    if quality is None:
        keyed = keyed.withColumn("quality", F.lit(1.0))
    else:
        keyed = keyed.join(quality, "doc_id", "left").withColumn("quality", F.coalesce("quality", F.lit(1.0)))
    return keyed.withColumn("key", -F.log(unit(F.col("doc_id"))) / F.col("quality")).drop("quality")


def plan(docs: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """doc_id, source, tie, size, source_size, target, times and taken of every row.

    ``quality`` has one row (doc_id, quality > 0) per known document; others weigh 1. Twice the
    quality is twice the chance to be the next document drawn.
    """
    rows = written(_keyed(docs, quality), "keyed")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
    sources = targets(sources, weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0)
    sources = sources.withColumn("_epochs", epochs.cast("long")).withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
    sources = written(sources, "sources")

    same = lambda x, y: F.col(x).eqNullSafe(F.col(y))
    rows = rows.join(sources.withColumnRenamed("source", "_source"), same("source", "_source")).drop("_source")
    # 1 - exp(-key) spreads keys of quality 1 evenly and keeps their order
    cuts = F.ceil(F.col("_n") / SLICE)
    rows = rows.withColumn("_slice", F.floor((1 - F.exp(-F.col("key"))) * cuts))
    slices = rows.groupBy("source", "_slice").agg(F.sum("size").alias("_in"))
    upto = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("_in").over(upto), F.lit(0)))
    slices = written(slices, "slices").select(F.col("source").alias("_source"), F.col("_slice").alias("_at"), "_in", "_before")
    rows = rows.join(slices, same("source", "_source") & (F.col("_slice") == F.col("_at"))).drop("_source", "_at")

    # whole slices need no order; in the slice that holds the target, sum up row by row
    split = (F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_in") > F.col("_rest"))
    inside = Window.partitionBy("source", "_slice").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    whole = rows.where(~split).withColumn("_more", (F.col("_before") + F.col("_in") <= F.col("_rest")).cast("int"))
    part = rows.where(split).withColumn("_cum", F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    part = part.withColumn("_more", (F.col("_cum") + F.col("size") / 2 <= F.col("_rest")).cast("int")).drop("_cum")
    rows = whole.unionByName(part).withColumn("times", F.col("_epochs") + F.col("_more"))
    return rows.select("doc_id", "source", "tie", "size", "source_size", "target", "times", (F.col("size") * F.col("times")).alias("taken"))


def quality_weights(labels: DataFrame) -> DataFrame:
    """Labelled good documents weigh 2, bad ones 1/2; the better label wins if there are several."""
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q"))
    return good.select("doc_id", F.when(F.col("q") > 0, 2.0).otherwise(0.5).alias("quality"))


def mixed(docs: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """The rows of the mix: every row as often as it is taken, with all columns of ``docs``."""
    times = plan(docs, quality, weights, most).groupBy("doc_id", "source", "tie").agg(F.sum("times").alias("_t"), F.count("*").alias("_c"))
    times = times.select(F.col("doc_id").alias("_i"), F.col("source").alias("_s"), F.col("tie").alias("_x"), "_t", "_c").where("_t > 0")
    packed = docs.select(F.struct("*").alias("row"))
    pick = F.col("row.doc_id").cast("long").eqNullSafe(F.col("_i")) & F.col("row.source").eqNullSafe(F.col("_s")) & (F.xxhash64("row.text") == F.col("_x"))
    rows = packed.join(times, pick)
    # equal rows share their takes: the first of them get one more where it does not come out even
    share = F.floor(F.col("_t") / F.col("_c")).cast("int")
    alone = rows.where("_c = 1").select("row", F.col("_t").cast("int").alias("_k"))
    copy = F.row_number().over(Window.partitionBy("_i", "_s", "_x").orderBy(F.lit(0)))
    equal = rows.where("_c > 1").select("row", (share + (copy <= F.col("_t") % F.col("_c")).cast("int")).alias("_k"))
    rows = alone.unionByName(equal).where("_k > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("_k")))).select("row.*")
