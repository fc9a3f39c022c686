"""Benchmark decontamination over a positional inverted index, in DataFrame operations alone.

A posting is (term, document, position) of the training texts. Test items are cut into windows of
consecutive words, and the rarest training terms of each window are its anchors; only terms that are
anchors get postings. A posting is aligned with the items that hold its term by the offset between
both positions, and the lists of a window's anchors are intersected at equal offsets. What is left is
few: there every word of the item meets the document's word at its place, which gives exact phrases; an
item of which many anchors stand at about the same offset is a proximity match, exact or not.

Tables of terms and ids are sent to every task only up to a checked number of rows; beyond that they
are joined by shuffle, with frequent terms spread by salt.

Defined results: a null or empty text has no words and is clean. An item without words matches
nothing; repeated items match as one, and a null item_id is left out of the list of items. Documents
that share an id, or have none, are each judged by their own text. Extra columns, whatever their names,
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumenloom.llm.tables import written

WINDOW = 13
#: Anchors of a window whose lists are intersected.
RAREST = 3
#: Rows sent to every task at most: terms and anchors (100 bytes each), document ids (8 bytes each).
FEW_TERMS, FEW_IDS = 200_000, 1_000_000
SALTS = 32
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case: letters, digits and anything beyond ASCII."""
    plain = F.octet_length(text) == F.length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), _BETWEEN), "")


def _small(df: DataFrame, most: int) -> DataFrame:
    """The written table, to be sent to every task if it has few rows."""
    return F.broadcast(df) if df.count() <= most else df


def items_of(benchmark: DataFrame) -> DataFrame:
    """k (a key), item_id, ws (the item's words) and need (words of one of its windows)."""
    items = benchmark.select("item_id", words(F.col("text")).alias("ws")).where("size(ws) > 0").distinct()
    items = items.withColumn("need", F.least(F.lit(WINDOW), F.size("ws")))
    return written(items.withColumn("k", F.xxhash64("item_id", "ws")), "items")


def anchors_of(items: DataFrame, docs: DataFrame) -> DataFrame:
    """The anchors: term, k and at (place in the item)."""
    placed = items.select("k", "need", F.size("ws").alias("size"), F.posexplode("ws").alias("pos", "term"))
    terms = written(placed.select("term").distinct(), "terms")
    # outer, or the planner would split every text twice, once to see whether it has words
    seen = docs.select(F.explode_outer(words(F.col("text"))).alias("term")).join(_small(terms, FEW_TERMS), "term", "left_semi")
    rarity = terms.join(seen.groupBy("term").agg(F.count("*").alias("df")), "term", "left").fillna(0, ["df"])
    ahead = Window.partitionBy("k").orderBy("pos").rowsBetween(0, WINDOW - 1)
    placed = placed.join(rarity, "term").withColumn("seen", F.collect_list(F.struct("df", "pos", "term")).over(ahead))
    starts = placed.where(F.col("pos") + F.col("need") <= F.col("size"))
    rarest = F.slice(F.sort_array("seen"), 1, RAREST)
    return written(starts.select("k", F.explode(rarest).alias("a")).select("a.term", "k", F.col("a.pos").alias("at")).distinct(), "anchors")


def postings(anchors: DataFrame, docs: DataFrame) -> DataFrame:
    """One row per posting of an anchor term and place in an item: doc_id, k, at and shift."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode_outer(words(F.col("text"))).alias("pos", "term"))
    if anchors.count() <= FEW_TERMS:
        hits = rows.join(F.broadcast(anchors), "term")
    else:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "pos"), F.lit(SALTS)))
        hits = rows.join(anchors.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["term", "salt"])
    return hits.select("doc_id", "k", "at", (F.col("pos") - F.col("at")).alias("shift"))


def phrase_matches(items: DataFrame, anchors: DataFrame, docs: DataFrame, posted: DataFrame | None = None) -> DataFrame:
    """doc_id, item_id, first and last: stretches of a document that are windows of an item.

    Ids have to tell rows of ``docs`` apart. ``posted`` are its postings, if they are there already.
    """
    posted = postings(anchors, docs) if posted is None else posted
    # the intersection: an occurrence has all anchors of its window at one offset
    met = posted.groupBy("doc_id", "k", "shift").agg(F.count("*").alias("n"))
    met = met.join(items.select("k", "need"), "k").where(F.col("n") >= F.least(F.lit(RAREST), F.col("need")))
    met = written(met.select("doc_id", "k", "shift"), "alignments")
    texts = docs.join(_small(met.select("doc_id").distinct(), FEW_IDS), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    spoken = texts.select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    # every word of an aligned item meets the document's word at its place: no row holds a text or an item
    lines = met.join(items.select("k", F.posexplode("ws").alias("at", "term")), "k")
    lines = lines.select("doc_id", "k", "shift", "at", (F.col("shift") + F.col("at")).alias("pos"), "term")
    same = lines.join(spoken, ["doc_id", "pos", "term"]).groupBy("doc_id", "k", "shift").agg(F.array_sort(F.collect_list("at")).alias("same"))
    # a window occurs where as many words in a row are the same
    same = same.join(items.select("k", "item_id", "need"), "k").where(F.size("same") >= F.col("need"))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("same") - F.col("need")),
        lambda j: F.get("same", j + F.col("need") - 1) - F.get("same", j) == F.col("need") - 1,
    )
    runs = same.select("doc_id", "item_id", "need", "shift", "same", F.explode(starts).alias("j"))
    first = F.col("shift") + F.get("same", F.col("j"))
    return runs.select("doc_id", "item_id", first.alias("first"), (first + F.col("need") - 1).alias("last"))


def proximity_matches(
    items: DataFrame, anchors: DataFrame, docs: DataFrame, share: float = 0.5, slack: int = 4, posted: DataFrame | None = None
) -> DataFrame:
    """doc_id, item_id, shift, n_anchors, n_found: items of which at least ``share`` of the anchors
    stand in the document at about the same offset (within ``slack`` words), in exact phrases or not."""
    total = anchors.groupBy("k").agg(F.count("*").alias("n_anchors"))
    # every offset is seen from its own band and from the one below, so some band of 2 * slack holds any range of slack
    band = F.floor(F.col("shift") / slack)
    bands = (postings(anchors, docs) if posted is None else posted).select("doc_id", "k", "at", F.explode(F.array(band - 1, band)).alias("band"))
    found = bands.groupBy("doc_id", "k", "band").agg(F.countDistinct("at").alias("n_found"))
    best = found.groupBy("doc_id", "k").agg(F.max("n_found").alias("n_found"), (F.max_by("band", "n_found") * slack).alias("shift"))
    best = best.join(total, "k").where(F.col("n_found") >= share * F.col("n_anchors"))
    return best.join(items.select("k", "item_id"), "k").select("doc_id", "item_id", "shift", "n_anchors", "n_found")


def contamination(docs: DataFrame, benchmark: DataFrame, near: bool = False) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (ids as sorted strings), items_sha256 and contaminated.

    A document is contaminated if at least a twentieth of its words stand in windows of items. With
    ``near`` a column n_near follows: the number of items that are proximity matches, exact or not.
    """
    number = F.col("doc_id").cast("long")
    # an id is a name only: rows are known by a hash of id and text
    docs = docs.select(number.alias("id"), F.xxhash64(number, "text").alias("doc_id"), "text")
    index = items_of(benchmark)
    anchors = anchors_of(index, docs)
    posted = written(postings(anchors, docs), "postings") if near else None
    found = written(phrase_matches(index, anchors, docs, posted), "phrases")
    spots = found.select("doc_id", F.explode(F.sequence("first", "last")).alias("pos")).distinct()
    hits = spots.groupBy("doc_id").agg(F.count("*").alias("n_hit"))
    items = found.where("item_id IS NOT NULL").select("doc_id", F.col("item_id").cast("string").alias("item")).distinct()
    items = items.groupBy("doc_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    marks = hits.join(items, "doc_id", "full")
    if near:
        close = proximity_matches(index, anchors, docs, posted=posted).groupBy("doc_id").agg(F.count_distinct("item_id").alias("n_near"))
        marks = marks.join(close, "doc_id", "full")
    sizes = docs.select("id", "doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    rows = sizes.join(marks, "doc_id", "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    others = [F.coalesce("n_near", F.lit(0)).alias("n_near")] if near else []
    rows = rows.select(F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), items.alias("items"), *others)
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        *(["n_near"] if near else []),
    )
