"""From raw documents to token files: quality rules, near duplicates, decontamination, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last give the columns they got.

Defined results: a document without an id is known by its text. Rows that repeat id and text count as
copies of one document; rows that share an id alone are documents of their own. Extra columns, whatever their names, are carried along. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenloom.llm import grammar_store, minhash_forest, phrase_index, rule_cascade, weighted_mix
from lumenloom.llm.tables import documents, written

#: Near duplicates share four fifths of their five-word shingles.
SHINGLE, PERCENT = 5, 80


def _packed(docs: DataFrame) -> DataFrame:
    """row (all columns), doc_id (a hash of id and text, so that no two documents share it), number and text.

    ``number`` is the id, or a hash of the text where there is none.
    """
    number = F.coalesce(F.col("doc_id").cast("long"), -F.abs(F.xxhash64("text") % (1 << 62)) - 1)
    return docs.select(F.struct("*").alias("row"), F.xxhash64(number, "text").alias("doc_id"), number.alias("number"), "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return rule_cascade.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    rows = _packed(docs)
    found = minhash_forest.near_duplicates(rows.select("doc_id", "text"), SHINGLE, PERCENT)
    found = found.groupBy("doc_id").agg(F.first("component_id").alias("component"), (F.count("*") > 1).alias("many"))
    found = written(found.join(rows.select("doc_id", "number").distinct(), "doc_id"), "found")
    firsts = found.groupBy("component").agg(F.min(F.struct("number", "doc_id")).alias("first"), F.count("*").alias("n")).where("n > 1")
    marks = found.join(firsts, "component", "left").select("doc_id", F.expr("coalesce(first.doc_id <> doc_id, false)").alias("gone"), "many").where("gone OR many")
    left = rows.join(marks, "doc_id", "left").where("NOT coalesce(gone, false)")
    once = left.where("NOT coalesce(many, false)").select("row.*")
    return once.unionByName(left.where("many").dropDuplicates(["doc_id"]).select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in benchmark items."""
    rows = _packed(docs)
    found = phrase_index.contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.join(found.where("contaminated").select("doc_id").distinct(), "doc_id", "left_anti").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    labels = weighted_mix.quality_weights(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return weighted_mix.mixed(docs, labels)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what is read back from them per document."""
    return grammar_store.token_output(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("tokens", tokens),
]

#: The rows depend on rules, hashes and a tokenizer that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
