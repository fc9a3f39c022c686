"""Nearest vectors by cosine similarity or Euclidean distance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenloom.functions.vectors import MAX_DOUBLE

MOST_QUERIES = 256  # query vectors scored in one pass over the vectors


def vector_topk(
    vectors: DataFrame,
    query: list[float],
    k: int,
    metric: str = "cosine",
    key: str = "key",
    data: str = "data",
) -> DataFrame:
    """The k best (key, score): highest cosine similarity or lowest distance first."""
    scored = _scored(vectors, [query], k, metric, key, data)
    return scored.drop("query").orderBy(_order("score", metric), key).limit(k)


def vector_topk_many(
    vectors: DataFrame,
    queries: list[list[float]],
    k: int,
    metric: str = "cosine",
    key: str = "key",
    data: str = "data",
) -> DataFrame:
    """(query, key, score): the k best vectors of each query vector, by query number.

    Each task scores its Arrow batches as matrix products and hands on only its k
    best per query, so pairs are never materialised. The ranking window prunes to
    k rows per query before its shuffle as well. Ties go to the smaller key.
    """
    out = _scored(vectors, queries, k, metric, key, data)
    best_first = Window.partitionBy("query").orderBy(_order("score", metric), key)
    ranked = out.withColumn("rank", F.row_number().over(best_first))
    return ranked.where(F.col("rank") <= k).drop("rank")


def _scored(vectors, queries, k, metric, key, data) -> DataFrame:
    metric = metric.lower()
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    sizes = {len(q) for q in queries}
    if len(sizes) != 1:
        raise ValueError("all query vectors need the same dimension")
    slim = vectors.select(key, data)
    schema = f"query int, `{key}` {slim.schema[key].dataType.simpleString()}, score double"
    out = None
    for first in range(0, len(queries), MOST_QUERIES):
        wanted = np.asarray(queries[first : first + MOST_QUERIES], dtype=np.float64)
        scored = slim.mapInArrow(_scorer(wanted, first, k, metric, key, data), schema)
        out = scored if out is None else out.unionByName(scored)
    return out


def _order(column: str, metric: str):
    return F.desc(column) if metric.lower() == "cosine" else F.asc(column)


def _scorer(wanted: np.ndarray, first: int, k: int, metric: str, key: str, data: str):
    dimension = wanted.shape[1]
    wanted_norms = np.sqrt((wanted**2).sum(axis=1))

    def scores_of(lists: pa.Array) -> np.ndarray:
        """Scores (vectors x queries); a vector of another size scores worst."""
        n = len(lists)
        lengths = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
        fits = lengths == dimension
        worst = 0.0 if metric == "cosine" else MAX_DOUBLE
        out = np.full((n, len(wanted)), worst)
        if not fits.any():
            return out
        flat = lists.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
        matrix = flat.astype(np.float64).reshape(-1, dimension)
        if metric == "cosine":
            norms = np.sqrt((matrix**2).sum(axis=1))[:, None] * wanted_norms[None, :]
            good = np.divide(matrix @ wanted.T, norms, out=np.zeros_like(norms), where=norms > 0)
        else:
            good = np.stack([np.sqrt(((matrix - q) ** 2).sum(axis=1)) for q in wanted], axis=1)
        out[fits] = good
        return out

    def best_of(batches):
        held: list[pa.Table | None] = [None] * len(wanted)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            scores = scores_of(_flat(table.column(data)))
            keys = _flat(table.column(key))
            loss = -scores if metric == "cosine" else scores
            for q in range(len(wanted)):
                column = loss[:, q]
                # all ties of the k-th value go on; the key decides between them below
                edge = np.partition(column, k - 1)[k - 1] if len(column) > k else np.inf
                kept = np.nonzero(column <= edge)[0]
                found = pa.table({"key": keys.take(pa.array(kept)), "loss": column[kept], "score": scores[kept, q]})
                if held[q] is not None:
                    found = pa.concat_tables([held[q], found])
                held[q] = found.sort_by([("loss", "ascending"), ("key", "ascending")]).slice(0, k)
        for q, found in enumerate(held):
            if found is not None:
                numbers = pa.array(np.full(len(found), first + q, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [numbers, _flat(found.column("key")), _flat(found.column("score"))],
                    names=["query", key, "score"],
                )

    return best_of


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
