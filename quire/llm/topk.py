"""Exact top-k by inner product with the threshold algorithm over sorted per-dimension lists.

Candidates are dealt into blocks by hash, queries into groups; a task holds one block with its
per-dimension order and answers one group of queries on it. For a query it goes down the lists
from their best ends (the large values where the query is positive, the small ones where it is
negative), scores every vector it meets, and stops when the sum of the values at the present
depth, the most any unseen vector can score, is below the k-th best score so far. A last
aggregation merges the blocks' best rows of each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows a block of candidates and a group of queries aim at: what one task holds.
BLOCK_ROWS = 20_000
QUERY_ROWS = 2_000
#: Depth of the first step down the lists; it doubles from step to step.
FIRST_DEPTH = 8

_SAFE = 2**62


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of whole numbers, short ones filled with zeros; Python integers where 64 bits could overflow."""
    exact = all(np.abs(v).max(initial=0) < 2**53 for v in vectors)
    out = np.zeros((len(vectors), width), np.int64 if exact else object)
    for i, vector in enumerate(vectors):
        out[i, : len(vector)] = vector if exact else [int(x) for x in vector]
    return out


def _fits(a: np.ndarray, b: np.ndarray) -> bool:
    if a.dtype == object or b.dtype == object:
        return False
    return int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1) < _SAFE


class Block:
    """Candidates with each dimension's order, rows by ascending id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.lists = np.argsort(self.vectors, axis=0, kind="stable")

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the ``k`` best, ties to the smaller id; the query's own id left out."""
        n = len(self.ids)
        dims = np.flatnonzero(query)
        weights = query[dims]
        up = weights > 0
        seen = self.ids == query_id
        rows, scores = np.flatnonzero(seen)[:0], query[:0]
        if not len(dims):  # every score is 0
            rows = np.flatnonzero(~seen)[:k]
            return rows, np.zeros(len(rows), query.dtype)
        depth, step = 0, FIRST_DEPTH
        while depth < n:
            stop = min(n, depth + step)
            met = np.concatenate([
                self.lists[n - stop : n - depth][:, dims[up]].ravel(), self.lists[depth:stop][:, dims[~up]].ravel()
            ])
            met = np.unique(met[~seen[met]])
            seen[met] = True
            rows = np.concatenate([rows, met])
            scores = np.concatenate([scores, self.vectors[met] @ query])
            if len(rows) > k:
                kept = np.lexsort((rows, -scores))[:k]
                rows, scores = rows[kept], scores[kept]
            ends = np.where(up, self.lists[n - stop, dims], self.lists[stop - 1, dims])
            bound = (self.vectors[ends, dims] * weights).sum()
            # An unseen vector may reach the bound, and one that ties may have a smaller id.
            if len(rows) == k and scores.min() > bound:
                break
            depth, step = stop, step * 2
        kept = np.lexsort((rows, -scores))
        return rows[kept], scores[kept]


def _answer(block: pd.DataFrame, queries: pd.DataFrame, k: int) -> Iterator[tuple]:
    if not len(block) or not len(queries):
        return
    width = max(max(map(len, block.vector)), max(map(len, queries.vector)))
    vectors, asked = _matrix(block.vector, width), _matrix(queries.vector, width)
    if not _fits(vectors, asked):
        vectors, asked = vectors.astype(object), asked.astype(object)
    held = Block(block.id.to_numpy(), vectors)
    for query_id, query in zip(queries.id, asked, strict=True):
        for row, score in zip(*held.best(query_id, query, k), strict=True):
            yield query_id, held.ids[row], max(-(2**63), min(2**63 - 1, int(score)))


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, vector): components as floor(scale * x); vectors null or with null or non-finite parts are left out."""
    parts = F.col(vector).cast("array<double>")
    usable = parts.isNotNull() & F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(parts, lambda x: F.rint(F.floor(F.lit(float(scale)) * x).cast("double")))
    return df.where(usable & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), scaled.alias("vector"))


def top_k(
    df: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest integer inner products, all rows if fewer.

    ``is_query`` is a condition on ``df``; candidates are all rows but those with the query's own
    id. Ties go to the smaller id. Vectors null, or holding null or non-finite components, and
    rows without an id take no part; a shorter vector counts as filled with zeros. Of queries
    with one id the first vector in array order asks; a repeated candidate row counts as often
    as it occurs. Scores beyond 64 bits are held at the limit. Empty input gives no rows.

    Every pair of a query group and a block is one task's work: candidates are copied once per
    query group, queries once per block, and a task gives at most ``k`` rows a query. Neither side
    is collected or broadcast.
    """
    spark = df.sparkSession
    base = whole_vectors(df, key, vector, scale)
    asked = whole_vectors(df.where(is_query), key, vector, scale).groupBy("id").agg(F.min("vector").alias("vector"))
    counts = base.agg(F.count("*").alias("n")).first()["n"], asked.count()
    blocks = max(1, -(-counts[0] // BLOCK_ROWS), min(spark.sparkContext.defaultParallelism, counts[0] // 500))
    groups = max(1, -(-counts[1] // QUERY_ROWS))
    place = F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")

    def each(number: int):
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    held = base.select("id", "vector", place.alias("block"), each(groups).alias("query_group"))
    queries = asked.select("id", "vector", group.alias("query_group"), each(blocks).alias("block"))

    def work(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_answer(block, queries, k), columns=["query_id", "vec_id", "score"]).astype("int64")

    found = (
        held.groupBy("block", "query_group")
        .cogroup(queries.groupBy("block", "query_group"))
        .applyInPandas(work, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
