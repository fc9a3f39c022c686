"""Spelling variants of a corpus' words, grouped under their most frequent form (PartEnum signatures).

A word is read as the binary vector of its letter multiset. One inserted or deleted letter changes
one place of that vector, one replaced letter changes two, so words one edit apart are within a Hamming
distance of two. The letters are dealt into PARTS parts; a signature is the content of all parts but one
(lengths that differ by one) or but two (equal lengths), for every choice of the parts left out. Two
words one edit apart agree in at least one signature, so an equality join on signatures finds every
pair. As one edit also leaves the first or the last half of a word as it is, each signature is made
once with either half, which keeps the groups of a signature small. Every pair is verified, and it
counts in one signature only: the first that both words share.

Defined results: a null text has no words; a null id is the empty text in the checksum that damages
runs. Repeated rows count again. Ties between forms of equal count go to the smallest in code-point
order. An empty table gives no rows. Columns besides id and text are not read, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenloom.llm.tables import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-zÀ-ÿ]+"
#: A run whose checksum this divides loses one letter.
DAMAGE = 199
#: Words have at least LEAST letters and FEWEST occurrences; a form is TIMES as frequent as its variants.
LEAST, FEWEST, TIMES = 6, 5, 5
PARTS = 5


def runs(docs: DataFrame) -> DataFrame:
    """The runs of letters of ``docs`` (doc_id, text) as they are after the damage: column word."""
    found = F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0)))
    taken = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), found.alias("run"))
    taken = taken.where(F.length("run") >= LEAST).select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return taken.select(F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """Words of at least LEAST letters that occur FEWEST times or more: word, n."""
    counted = runs(docs).where(F.length("word") >= LEAST).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= FEWEST)


def _parts() -> Column:
    """A hash of the sorted letters of each part."""
    letters = F.array_sort(F.split("word", ""))
    part = lambda k: F.xxhash64(F.array_join(F.filter(letters, lambda c: F.ascii(c) % PARTS == k), ""))
    return F.array(*[part(k) for k in range(PARTS)])


def _signatures(size: Column, short: Column, left_out: int) -> Column:
    """(key, skipped, half) for every choice of parts left out, with the first and with the last half.

    ``size`` is the longer length of a pair, ``short`` the shorter one.
    """
    half = F.floor(short / 2).cast("int")
    halves = [F.substring("word", F.lit(1), half), F.substring("word", F.length("word") - (short - half) + 1, short)]
    made = []
    for skipped in combinations(range(PARTS), left_out):
        rest = [F.col("parts")[k] for k in range(PARTS) if k not in skipped]
        for i, text in enumerate(halves):
            key = F.xxhash64(F.lit(left_out), size, *map(F.lit, skipped), *rest, F.lit(i), text)
            made.append(F.struct(key.alias("key"), F.array(*map(F.lit, skipped)).alias("skipped"), F.lit(i).alias("half")))
    return F.explode(F.array(*made))


def near_pairs(words: DataFrame) -> DataFrame:
    """Each pair of ``words`` (word) that differ by exactly one inserted, deleted or replaced letter, once: a, b."""
    words = written(words.select("word", _parts().alias("parts")), "word-parts")
    size = F.length("word")
    side = lambda long_, short, out: words.select("word", "parts", _signatures(long_, short, out).alias("s"))
    same = side(size, size, 2)
    longer = same.unionByName(side(size, size - 1, 1)).select(F.col("s.key").alias("key"), F.col("word").alias("a"), F.col("parts").alias("parts_a"), "s.skipped", "s.half")
    shorter = same.unionByName(side(size + 1, size, 1)).select(F.col("s.key").alias("key"), F.col("word").alias("b"), F.col("parts").alias("parts_b"))
    met = longer.join(shorter, "key").where((F.length("a") > F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b"))))

    # the first signature a pair shares leaves out the parts that differ, and the first part there is besides them
    differ = F.filter(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda k: F.get("parts_a", k) != F.get("parts_b", k))
    filled = F.when(F.size("differ") >= F.size("skipped"), F.col("differ")).otherwise(
        F.array_sort(F.concat("differ", F.array(F.when(F.array_contains("differ", 0), 1).otherwise(0))))
    )
    half = F.floor(F.length("b") / 2).cast("int")
    first = F.substring("a", F.lit(1), half) == F.substring("b", F.lit(1), half)
    met = met.where((F.col("half") == 0) | ~first).withColumn("differ", differ).where(F.col("skipped") == filled)
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b")


def _followed(forms: DataFrame) -> DataFrame:
    """The last word of each chain of ``forms`` (word, form): word, root. A step doubles what is followed."""
    reached = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        reached = step.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """Every word of ``docs`` (doc_id, text) with its form, the root its forms lead to, and its near words.

    Returns word, form, root, n, n_near, form_n. The form is the near word of largest count, if that
    is at least TIMES the word's own; else it is null and so is form_n.
    """
    words = written(vocabulary(docs), "vocabulary")
    pairs = written(near_pairs(words), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    known = both.join(words.toDF("b", "n_b"), "b")
    best = known.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("n"), "b")).alias("best"))
    found = words.join(best, "word", "left")
    formed = -F.col("best.n") >= TIMES * F.col("n")
    found = written(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best.b")).alias("form"), F.when(formed, -F.col("best.n")).alias("form_n")), "forms")
    roots = _followed(found.where("form IS NOT NULL"))
    found = found.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
