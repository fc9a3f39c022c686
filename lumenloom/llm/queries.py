"""The registered queries of this subpackage, over the whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumenloom.llm import (
    boundary_bpe,
    conversation_repair,
    grammar_store,
    language_id,
    length_histogram,
    lm_automaton,
    minhash_forest,
    phrase_index,
    rule_cascade,
    secret_scan,
    sparse_suffixes,
    spelling_variants,
    weighted_mix,
)
from lumenloom.llm.sql_twins import REPAIR_SQL, VARIANTS_SQL
from lumenloom.llm.tables import documents

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        LLM_QUERIES[name] = fn
        if sql:
            LLM_ORACLES[name] = sql
        return fn

    return add


@query("op2_lm_automaton")
def op2_lm_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_automaton.score_documents(documents(spark, sf_dir))


@query("op3_minhash_forest")
def op3_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(documents(spark, sf_dir), words_each=3, percent=85)


@query("op7_rule_cascade")
def op7_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_cascade.judge(documents(spark, sf_dir))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


_MIX_SQL = """
WITH q AS (SELECT doc_id, CASE WHEN max(quality) > 0 THEN 2.0 ELSE 0.5 END AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    -ln((('0x' || md5(CAST(d.doc_id AS VARCHAR))[1:12])::BIGINT + 0.5) / 281474976710656.0) / coalesce(q.quality, 1.0) AS key
  FROM documents d LEFT JOIN q USING (doc_id)),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 3 * source_size AS most FROM s),
c AS (SELECT a.source, a.w, a.most, a.source_size,
    coalesce(sum(b.most) FILTER (WHERE b.most / b.w < a.most / a.w), 0) AS full_, sum(b.w) FILTER (WHERE b.most / b.w >= a.most / a.w) AS open_
  FROM w a CROSS JOIN w b GROUP BY ALL),
l AS (SELECT max(((SELECT sum(source_size) FROM s) - full_) / open_) AS level FROM c),
t AS (SELECT source, source_size, least(most, (SELECT level FROM l) * w)::DOUBLE AS target FROM w),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-12) ELSE 0 END::BIGINT AS epochs FROM t),
r AS (SELECT d.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (epochs + CASE WHEN cum + size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""


@query("op10_weighted_mix", _MIX_SQL)
def op10_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = weighted_mix.quality_weights(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = weighted_mix.plan(documents(spark, sf_dir), quality)
    return found.select("doc_id", "size", "source_size", "target", "taken")


_PHRASE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS win FROM b WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i, unnest(list_transform(range(1, greatest(len(w) - n + 2, 1)), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win FROM d, lens),
m AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
o AS (SELECT DISTINCT item_id, w FROM b WHERE len(w) > 0),
q AS (SELECT row_number() OVER () AS k, item_id, w FROM o),
qw AS (SELECT k, len(w) AS n, least(13, len(w)) AS need, unnest(range(len(w))) AS pos, unnest(w) AS term FROM q),
dd AS (SELECT doc_id, unnest(range(len(w))) AS pos, unnest(w) AS term FROM d),
df AS (SELECT term, count(*) AS df FROM dd GROUP BY term),
qs AS (SELECT k, s, a.pos, a.term, row_number() OVER (PARTITION BY k, s ORDER BY coalesce(df, 0), a.pos, a.term) AS r FROM (SELECT *, unnest(range(greatest(0, pos - need + 1), least(pos, n - need) + 1)) AS s FROM qw) a LEFT JOIN df USING (term)),
an AS (SELECT DISTINCT k, pos AS at_, term FROM qs WHERE r <= 3),
po AS (SELECT doc_id, k, at_, unnest([floor((pos - at_) / 4) - 1, floor((pos - at_) / 4)]) AS band FROM dd JOIN an USING (term)),
pb AS (SELECT doc_id, k, band, count(DISTINCT at_) AS n FROM po GROUP BY ALL),
ne AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM (SELECT doc_id, k, max(n) AS n FROM pb GROUP BY ALL) JOIN (SELECT k, count(*) AS most FROM an GROUP BY k) USING (k) JOIN q USING (k) WHERE n >= 0.5 * most GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id) LEFT JOIN ne USING (doc_id)
"""


@query("op6_phrase_index", _PHRASE_SQL)
def op6_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return phrase_index.contamination(documents(spark, sf_dir), benchmark, near=True).drop("items")


@query("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


@query("op8_length_histogram")
def op8_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.answers(length_histogram.histogram(documents(spark, sf_dir)))


_SUFFIX_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(range(0, greatest(len(w) - 49, 0))) AS i, unnest(list_transform(range(1, greatest(len(w) - 49, 0) + 1), lambda k: hash(array_to_string(w[k:k + 49], ' ')))) AS win FROM d),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY win) AS n FROM x) WHERE n > 1),
p AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM r),
g AS (SELECT doc_id, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS grp, pos FROM p),
s AS (SELECT doc_id, min(pos) AS a, max(pos) + 1 AS b FROM g GROUP BY doc_id, grp),
t AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_repeated, count(*) AS n_spans, string_agg(a || ':' || b, ',' ORDER BY a) AS spans FROM s GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_repeated, 0) AS n_repeated, coalesce(n_spans, 0) AS n_spans, coalesce(spans, '') AS spans
FROM d LEFT JOIN t USING (doc_id)
"""


@query("op1_sparse_suffixes", _SUFFIX_SQL)
def op1_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_suffixes.repeated_passages(documents(spark, sf_dir))


@query("op4_grammar_store")
def op4_grammar_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar_store.token_output(documents(spark, sf_dir))


@query("op11_conversation_repair", REPAIR_SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("op12_boundary_bpe")
def op12_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return boundary_bpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op13_spelling_variants", VARIANTS_SQL)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(documents(spark, sf_dir))
