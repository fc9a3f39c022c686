"""The pipeline, stage by stage, against plain versions of the contracts."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

import corpus_pipeline as cp
from lumenloom.llm import rule_cascade
from lumenloom.llm.encoding import default_path
from lumenloom.llm.tables import documents, written
from tests.llm import brute


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    out, docs = {}, documents(spark, sf_dir)
    out["start"] = docs.collect()
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        out[name] = docs.collect()
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_quality(stages):
    texts = [r.text.encode() if r.text is not None else None for r in stages["start"]]
    ok = rule_cascade.cascade(rule_cascade.Texts(texts), [*rule_cascade.BASE, *rule_cascade.RULES]) < 0
    assert ids(stages["quality"]) == sorted(r.doc_id for r, k in zip(stages["start"], ok) if k)
    assert 0 < len(stages["quality"]) < len(stages["start"])


def test_near_duplicates(stages):
    found = brute.components([(r.doc_id, r.text) for r in stages["quality"]], 5, 80)
    assert ids(stages["near_duplicates"]) == sorted(d for d, (_, c) in found.items() if d == c)


def test_decontamination(spark, sf_dir, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = brute.contamination([(r.doc_id, r.text) for r in stages["near_duplicates"]], items)
    assert ids(stages["decontamination"]) == sorted(d for d, (n, hit, _) in found.items() if not (hit and 20 * hit >= n))


def test_mix(stages):
    sizes = {}
    for r in stages["decontamination"]:
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.words(r.text))
    taken, longest = {}, max(len(brute.words(r.text)) for r in stages["decontamination"])
    for r in stages["mix"]:
        taken[r.source] = taken.get(r.source, 0) + len(brute.words(r.text))
    for s, t in brute.targets(sizes).items():
        assert abs(taken.get(s, 0) - t) <= longest


def test_tokens(stages):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(default_path())
    rows, at = sorted(stages["tokens"], key=lambda r: r.start), 0
    for r, d in zip(rows, sorted(stages["mix"], key=lambda r: (r.doc_id, r.text)), strict=True):
        found = np.array(tok.encode(d.text, add_special_tokens=False).ids + [0], dtype="<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, at, found.size, zlib.crc32(found.tobytes()))
        at += found.size


def test_columns_and_run(spark, sf_dir, stages):
    for name in ("quality", "near_duplicates", "decontamination", "mix"):
        assert stages[name][0].__fields__ == stages["start"][0].__fields__
    whole = cp.run(spark, sf_dir).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, stages["tokens"]))


def test_odd_rows(spark, sf_dir):
    text = " ".join(f"the {chr(97 + i % 23)}{chr(97 + i % 19)}{chr(97 + i % 17)}a of" for i in range(60))
    other = " ".join(f"and {chr(97 + i % 13)}{chr(97 + i % 11)}{chr(97 + i % 7)}b to" for i in range(60))
    rows = [(1, text, "en", "s", 1, 2, 3), (1, text, "en", "s", 1, 2, 3), (None, text, "en", "s", 1, 2, 3), (5, None, None, None, None, None, None), (6, other, "en", None, 0, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row int, _k int")
    for name, stage in cp.STAGES:
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.count() == 0, name
        docs = written(stage(spark, docs, sf_dir), name)
        if name == "near_duplicates":
            assert docs.count() == 2  # one of the three copies, and the other text
    assert docs.count() > 0


def test_documents_that_share_an_id(spark, sf_dir):
    """Different texts under one id are documents of their own, with their own verdicts."""
    texts = [" ".join(f"{w} {chr(97 + i % a)}{chr(97 + i % b)}{w}" for i in range(80)) for w, a, b in (("the", 23, 19), ("and", 17, 13), ("of", 11, 7))]
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 80").orderBy("item_id").first().text
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (2, texts[0]), (3, texts[2]), (3, item), (0, texts[1] + " end")]
    docs = spark.createDataFrame([(d, t, "en", "s") for d, t in rows], "doc_id long, text string, lang string, source string")
    near = cp.near_duplicates(spark, docs, sf_dir)
    assert sorted((r.doc_id, r.text) for r in near.collect()) == sorted([(1, texts[0]), (3, texts[2]), (3, item), (0, texts[1] + " end")])
    clean = cp.decontamination(spark, near, sf_dir)
    assert sorted((r.doc_id, r.text) for r in clean.collect()) == sorted([(1, texts[0]), (3, texts[2]), (0, texts[1] + " end")])
