"""Near-duplicate documents by an LSH forest over MinHash signatures.

Each distinct shingle set is one representative, so copies cost one row each. A signature of
``trees * depth`` minima is read as several sorted orders, one per tree. In a tree, representatives
that share the first ``base`` minima form a region. A region with more than ``region`` members is
read one minimum deeper, and so on, so depth adapts to how crowded the place is; inside a region
neighbours in sorted order, which share the longest prefixes, become candidates. The members of a
region that had to be split are also paired with its most central member, so in no tree splitting
cuts a star of near copies around one original. Links are confirmed on full sets.

Splitting raises the chance that a pair is missed, and members of one template share minima without
being alike. So all members of crowded regions are joined once more without chance: the shingles of a
set are put in one order for all sets, rare ones first; two sets that are similar enough share one of
their first shingles (prefix filter). Pairs that are in one component by then need no test.

Defined results: a null text, or one without words, has no shingles and stays alone. Repeated rows
are copies. Rows that share an id but not the text are documents of their own, and each is linked by
its own text. A row with a null id stays alone, with a null component id, and is kept. Columns besides
id and text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumenloom.llm import textvec as tv
from lumenloom.llm.tables import connected_components, written

TREES, DEPTH = 16, 8
REGION, NEIGHBOURS = 16, 8
#: Buckets of shingle counts that the order of shingles comes from; any order gives the same links.
BUCKETS = 1 << 20
#: Members of a shingle's group that one piece of the prefix join holds.
PIECE = 2_000
#: Ids of documents in candidate pairs are sent to every task only up to this count (8 bytes each).
FEW_IDS = 1_000_000
MISSED = 2e-5


def base_depth(similarity: float) -> int:
    """The deepest prefix that all trees together miss with a chance below MISSED."""
    return max(d for d in range(1, DEPTH) if d == 1 or (1 - similarity**d) ** TREES <= MISSED)


def _signatures(words_each: int):
    a, b = tv.salts(TREES * DEPTH, 31), tv.salts(TREES * DEPTH, 32)
    schema = pa.schema(
        [("id", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("sig", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.slices(batch, "text", 2 << 20):
                sets, at = tv.shingle_sets(*tv.word_hashes(tv.texts_of(part.column("text")), lower=True), words_each)
                size = np.diff(at)
                full = np.flatnonzero(size)
                sig = np.full((part.num_rows, TREES * DEPTH), 0xFFFFFFFF, dtype=">u4")
                h = np.zeros((2, part.num_rows), dtype=np.uint64)
                if full.size:
                    first = at[:-1][full]
                    for k in range(TREES * DEPTH):
                        sig[full, k] = np.minimum.reduceat((sets * a[k] + b[k]) >> np.uint64(32), first)
                    h[0, full] = np.add.reduceat(sets, first)
                    h[1, full] = np.add.reduceat(tv.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), first)
                h = h.view(np.int64)
                rows = [part.column("id"), part.column("doc_id"), size, h[0], h[1], [r.tobytes() for r in sig]]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) if not isinstance(x, pa.Array) else x for x, f in zip(rows, schema)], schema=schema)

    return run


_SIGNATURE_SCHEMA = "id long, doc_id long, n_shingles long, h1 long, h2 long, sig binary"


def _prefix(depth: Column | int) -> Column:
    """Key of the region at a depth of the row's tree."""
    return F.xxhash64("tree", F.substring(F.col("order"), F.lit(1), F.lit(depth) * 4))


def candidates(reps: DataFrame, base: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a < b) of representatives (rep, sig) that the forest brings together, and the crowded ones."""
    width = DEPTH * 4
    forest = reps.select("rep", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "sig").select(
        "rep", "tree", F.substring("sig", F.col("tree") * width + 1, F.lit(width)).alias("order")
    )
    forest = forest.withColumn("key", _prefix(base))
    sizes = forest.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    forest = written(forest.join(sizes, "key"), "forest")
    calm = forest.where(F.col("size") <= REGION).select("rep", "order", "key", F.lit(REGION - 1).alias("most"))

    # crowded regions: one row per deeper level, then the first level that is small enough
    deeper = (
        forest.where(F.col("size") > REGION)
        .select("rep", "tree", "order", F.explode(F.sequence(F.lit(base), F.lit(DEPTH))).alias("level"))
        .withColumn("key", F.xxhash64("level", _prefix(F.col("level"))))
    )
    levels = deeper.groupBy("key").agg(F.count("*").alias("size"))
    deeper = written(deeper.join(levels, "key"), "levels")
    # one hub a region, where it first splits: deeper regions would name the same hubs again and again
    central = deeper.where(F.col("level") == DEPTH).groupBy("rep").agg(F.sum("size").alias("weight"))
    crowded = forest.where(F.col("size") > REGION).select("rep", "key").join(central, "rep")
    hubs = crowded.groupBy("key").agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("hub"))
    spokes = crowded.join(hubs, "key").where("rep <> hub").select("rep", "hub")
    spokes = spokes.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))

    fits = deeper.where((F.col("size") <= REGION) | (F.col("level") == DEPTH))
    fits = fits.withColumn("first", F.min("level").over(Window.partitionBy("rep", "tree"))).where("level = first")
    # these pairs link most of a crowd; exact_pairs sees to the rest, so large leaves are dealt into pieces
    piece = F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / REGION))
    fits = fits.select("rep", "order", F.xxhash64("key", piece).alias("key"), F.lit(NEIGHBOURS).alias("most"))

    ordered = Window.partitionBy("key").orderBy("order", "rep").rowsBetween(1, REGION - 1)
    near = (
        calm.unionByName(fits)
        .withColumn("others", F.slice(F.collect_list("rep").over(ordered), F.lit(1), F.col("most")))
        .select("rep", F.explode("others").alias("other"))
        .select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b"))
    )
    return near.unionByName(spokes).distinct(), forest.where(F.col("size") > REGION).select("rep").distinct()


def _counts(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in tv.slices(batch, "text", 2 << 20):
                sets, _ = tv.shingle_sets(*tv.word_hashes(tv.texts_of(part.column("text")), lower=True), words_each)
                np.add.at(count, _bucket(sets), 1)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "n": pa.array(count[some])})

    return run


def _bucket(sets: np.ndarray) -> np.ndarray:
    return (sets >> np.uint64(40)).astype(np.int64) % BUCKETS


def _prefixes(words_each: int, percent: int, rank: np.ndarray):
    """The first shingles of each set; ``small`` marks those that do where the other set is no smaller."""
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("shingle", pa.int64()), ("place", pa.int32()), ("small", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.slices(batch, "text", 2 << 20):
                sets, at = tv.shingle_sets(*tv.word_hashes(tv.texts_of(part.column("text")), lower=True), words_each)
                owner, n = tv.owners(at), np.diff(at)
                order = np.lexsort((sets, rank[_bucket(sets)], owner))
                place = np.arange(sets.size) - at[:-1][owner]
                # with o in common: o >= n * percent, and in the smaller set o >= 2 n * percent / (1 + percent)
                first = np.flatnonzero(place <= (n + -percent * n // 100)[owner])
                own = owner[first]
                small = place[first] <= (n + -2 * percent * n // (100 + percent))[own]
                rows = [np.asarray(part.column("doc_id"))[own], n[own], sets[order[first]].view(np.int64), place[first], small]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(rows, schema)], schema=schema)

    return run


def exact_pairs(texts: DataFrame, parts: DataFrame, words_each: int, percent: int) -> DataFrame:
    """Pairs (a < b) of ``texts`` (doc_id, text) that can be similar enough and are apart in ``parts`` (id, component)."""
    counts = texts.mapInArrow(_counts(words_each), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    rank = np.zeros(BUCKETS, dtype=np.uint8)
    rank[counts["bucket"].to_numpy()] = 4 * np.log2(1 + counts["n"].to_numpy(dtype=float))
    posts = texts.mapInArrow(_prefixes(words_each, percent, rank), "rep long, n long, shingle long, place int, small boolean")
    posts = posts.join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    posts = written(posts.withColumn("component", F.coalesce("component", "rep")), "prefixes")
    shared = posts.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.bool_or("small").alias("any"), F.count("*").alias("size"))
    shared = shared.where("lo <> hi AND any").select("shingle", F.ceil(F.col("size") / PIECE).alias("pieces"))
    posts = written(posts.join(written(shared, "shared"), "shingle"), "shared-prefixes")

    # a group of many members is dealt into pieces of its larger sets, each met by all smaller ones
    x = posts.where("small").select("shingle", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("place").alias("at_a"), F.col("component").alias("in_a"))
    y = posts.select("shingle", F.pmod(F.xxhash64("rep"), "pieces").alias("piece"), F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("place").alias("at_b"), F.col("component").alias("in_b"))
    both = x.join(y, ["shingle", "piece"]).where("in_a <> in_b AND n_a <= n_b").where(100 * F.col("n_a") >= percent * F.col("n_b"))
    # of the first shingle in common, no more than what follows it can be in common
    rest = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    both = both.where((100 + percent) * rest >= percent * (F.col("n_a") + F.col("n_b")))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _agreement(threshold: float):
    """Share of equal minima per pair; pairs five standard deviations below the threshold go."""
    least = threshold - 5 * (threshold * (1 - threshold) / (TREES * DEPTH)) ** 0.5
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("near", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u4").reshape(-1, TREES * DEPTH) for c in ("sig_a", "sig_b"))
            near = (x == y).mean(axis=1) if batch.num_rows else np.empty(0)
            keep = pa.array(near >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(near).filter(keep)], schema=schema)

    return run


def _confirm(words_each: int, percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def linked(x: np.ndarray, y: np.ndarray) -> bool:
        both = np.intersect1d(x, y, assume_unique=True).size
        return 100 * both >= percent * (x.size + y.size - both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.slices(batch, "text_a", 2 << 20):
                sets = []
                for c in ("text_a", "text_b"):
                    value, at = tv.shingle_sets(*tv.word_hashes(tv.texts_of(part.column(c)), lower=True), words_each)
                    sets.append([value[i:j] for i, j in zip(at, at[1:])])
                keep = pa.array([linked(x, y) for x, y in zip(*sets)], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], schema=schema)

    return run


def confirm_links(pairs: DataFrame, docs: DataFrame, words_each: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    texts = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(texts, "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_confirm(words_each, percent), "a long, b long")


def _placed(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs with the components of both ends, in_a and in_b."""
    for x in ("a", "b"):
        pairs = pairs.join(parts.select(F.col("id").alias(x), F.col("component").alias(f"in_{x}")), x, "left")
    return pairs.withColumns({f"in_{x}": F.coalesce(f"in_{x}", x) for x in ("a", "b")})


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components (id, component) once further links hold: whole components are linked, not their members."""
    ends = _placed(links, parts).select(F.col("in_a").alias("a"), F.col("in_b").alias("b"))
    top = written(connected_components(ends), "tops")
    moved = parts.join(top.toDF("component", "top"), "component", "left").select("id", F.coalesce("top", "component").alias("component"))
    return written(moved.unionByName(top.join(parts, "id", "left_anti")), "components")


def near_duplicates(docs: DataFrame, words_each: int = 5, percent: int = 80) -> DataFrame:
    """Component of every document under Jaccard >= percent / 100 of word shingles.

    ``docs`` has doc_id and text. Returns doc_id, n_shingles, component_id (smallest id reachable),
    kept (true for that smallest id) and component_row, which tells components apart even where their
    documents share an id: an id is a name only, a row is known by a hash of id and text.
    """
    number = F.col("doc_id").cast("long")
    docs = docs.select(number.alias("id"), F.xxhash64(number, "text").alias("doc_id"), "text")
    signed = written(docs.mapInArrow(_signatures(words_each), _SIGNATURE_SCHEMA), "signatures")
    sets = signed.where("n_shingles > 0 AND id IS NOT NULL").groupBy("h1", "h2", "n_shingles")
    reps = written(sets.agg(F.min("doc_id").alias("rep"), F.min_by("sig", "doc_id").alias("sig"), F.min("id").alias("first")), "representatives")

    pairs, crowded = candidates(reps.select("rep", "sig"), base_depth(percent / 100))
    side = lambda s: reps.select(F.col("rep").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}"))

    def agreeing(pairs: DataFrame) -> DataFrame:
        sized = pairs.join(side("a"), "a").join(side("b"), "b")
        sized = sized.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        return written(sized.mapInArrow(_agreement(percent / 100), "a long, b long, near double"), "pairs")

    def texts_of(ids: DataFrame) -> DataFrame:
        few = F.broadcast(ids) if ids.count() <= FEW_IDS else ids
        return written(docs.select("doc_id", "text").join(few, "doc_id", "left_semi"), "paired-texts").dropDuplicates(["doc_id"])

    pairs = agreeing(pairs)
    texts = texts_of(written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "paired"))

    # the most similar partner of each document first; after that only pairs still apart are left to test
    ends = [pairs.select(F.col(x).alias("id"), "a", "b", "near") for x in ("a", "b")]
    best = reduce(DataFrame.unionByName, ends).groupBy("id").agg(F.max_by(F.struct("a", "b"), F.struct("near", "a", "b")).alias("p"))
    links = written(confirm_links(best.select("p.a", "p.b").distinct(), texts, words_each, percent), "links")
    parts = written(connected_components(links), "components")
    apart = _placed(pairs, parts).where("in_a <> in_b").select("a", "b")
    tested = best.select("p.a", "p.b")
    more = confirm_links(apart.join(tested, ["a", "b"], "left_anti"), texts, words_each, percent)
    parts = _merged(parts, more)

    crowded = written(crowded.withColumnRenamed("rep", "doc_id"), "crowded")
    if not crowded.isEmpty():
        texts = texts_of(crowded)
        more = confirm_links(agreeing(exact_pairs(texts, parts, words_each, percent)).select("a", "b"), texts, words_each, percent)
        parts = _merged(parts, more)

    whole = reps.select("h1", "h2", "n_shingles", "rep", "first").join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    whole = written(whole.withColumn("component", F.coalesce("component", "rep")), "placed")
    named = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    whole = whole.join(named, "component").select("h1", "h2", "n_shingles", "component", "component_id")
    # a row without an id is in no set of its own, although another row may have the same one
    found = signed.withColumn("h1", F.when(F.col("id").isNotNull(), F.col("h1"))).join(whole, ["h1", "h2", "n_shingles"], "left")
    found = found.select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component_id", "id").alias("component_id"), F.coalesce("component", found["doc_id"]).alias("component_row"))
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "component_row")
