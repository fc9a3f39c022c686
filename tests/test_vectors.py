from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenloom.functions import vectors as fv
from lumenloom.operators import vectors as v

SCHEMA = "key string, data array<float>"


@pytest.fixture(scope="module")
def units(spark):
    data = [("x", [1.0, 0.0, 0.0]), ("y", [0.0, 1.0, 0.0]), ("z", [0.0, 0.0, 1.0]), ("xy", [1.0, 1.0, 0.0]), ("none", [0.0, 0.0, 0.0]), ("short", [1.0]), ("null", None)]
    return spark.createDataFrame(data, SCHEMA)


def keys(df):
    return [r.key for r in df.collect()]


def test_nearest(units):
    assert keys(v.vector_topk(units, [0.9, 0.1, 0.0], 1)) == ["x"]
    assert keys(v.vector_topk(units, [1.0, 0.9, 0.0], 2)) == ["xy", "x"]
    assert keys(v.vector_topk(units, [1.0, 0.6, 0.0], 2, "EUCLIDEAN")) == ["xy", "x"]


def test_degenerate_vectors(units):
    got = {r.key: r.score for r in v.vector_topk(units, [1.0, 0.0, 0.0], 10).collect()}
    assert got["none"] == got["short"] == got["null"] == 0.0 and got["xy"] == pytest.approx(2**-0.5)
    got = {r.key: r.score for r in v.vector_topk(units, [1.0, 0.0, 0.0], 10, "euclidean").collect()}
    assert got["short"] == fv.MAX_DOUBLE and got["none"] == 1.0
    got = {r.key: r.score for r in v.vector_topk(units, [0.0, 0.0, 0.0], 10).collect()}
    assert set(got.values()) == {0.0}


def test_ties_go_to_the_smaller_key(units):
    assert keys(v.vector_topk(units, [0.0, 0.0, -1.0], 2)) == ["none", "null"]


def test_bad_arguments(units):
    with pytest.raises(ValueError):
        v.vector_topk(units, [1.0], 1, "manhattan")
    with pytest.raises(ValueError):
        v.vector_topk_many(units, [[1.0], [1.0, 2.0]], 1)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_many_queries_agree_with_brute_force(spark, metric):
    rng = np.random.default_rng(7)
    # few distinct levels, so there are ties
    data = rng.integers(-1, 2, (400, 4)).astype(np.float32)
    queries = rng.integers(-1, 2, (5, 4)).astype(float)
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(data)], "key long, data array<float>").repartition(6)
    got = {}
    for r in v.vector_topk_many(df, queries.tolist(), 9, metric).collect():
        got.setdefault(r.query, []).append((r.key, r.score))
    for q, query in enumerate(queries):
        wide = data.astype(float)
        if metric == "cosine":
            norms = np.sqrt((wide**2).sum(1)) * np.sqrt((query**2).sum())
            score = np.divide(wide @ query, norms, out=np.zeros(len(wide)), where=norms > 0)
            loss = -score
        else:
            score = loss = np.sqrt(((wide - query) ** 2).sum(1))
        want = sorted(range(400), key=lambda i: (round(loss[i], 9), i))[:9]
        assert sorted(k for k, _ in got[q]) == sorted(want)
        assert dict(got[q]) == pytest.approx({i: score[i] for i in want})


def test_column_functions_agree(spark, units):
    query = F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0))
    got = {r.key: (r.c, r.e) for r in units.select("key", fv.cosine_similarity(F.col("data"), query).alias("c"), fv.euclidean_distance(F.col("data"), query).alias("e")).collect()}
    assert got["xy"][0] == pytest.approx(2**-0.5) and got["none"][0] == 0.0
    assert got["short"] == (0.0, fv.MAX_DOUBLE) and got["y"][1] == pytest.approx(2**0.5)
