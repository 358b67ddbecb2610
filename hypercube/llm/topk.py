"""Exact top-k search with segment statistics (operator 2)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hypercube.llm.common import table, written

TOP = 5
#: Components are taken as floor(SCALE * x).
SCALE = 256
#: Lengths of the segments, coarse to fine.
SEGMENTS = (16, 4)
#: Rows of a block of queries and of a block of candidates, about, and candidates compared at a time.
QUERIES, CANDIDATES, STEP = 8192, 4096, 1024


def _finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))


def _summary(x: np.ndarray, length: int) -> np.ndarray:
    """Segment means and deviations, scaled so that squared distances of these
    rows are the lower bounds of squared distances of the vectors."""
    parts = x.reshape(len(x), -1, length)
    return np.sqrt(length) * np.concatenate([parts.mean(axis=2), parts.std(axis=2)], axis=1)


def best_of_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, top: int) -> tuple[np.ndarray, ...]:
    """The ``top`` candidates of each query by inner product, ties to the smaller id: query ids, candidate ids, scores.

    With m and s the mean and deviation of a segment of length L, the squared
    distance of two vectors is at least the sum over segments of
    L((m - m')^2 + (s - s')^2).  The score is half of |q|^2 + |c|^2 less the
    squared distance, so the bound caps it.  Candidates come in order of id;
    those that no query's cap lets reach its present ``top`` are given up, by
    coarse segments, then by fine ones; the survivors' scores are exact.
    """
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    wide = -(-max(q.shape[1], 1) // SEGMENTS[0]) * SEGMENTS[0]
    q, c = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (q, c))
    q_norm, c_norm = (q * q).sum(axis=1), (c * c).sum(axis=1)
    exact = float(np.sqrt(q_norm.max() * c_norm.max())) * wide < 2.0 ** 53
    bounds = [(_summary(q, n), _summary(c, n)) for n in SEGMENTS]
    scores = np.full((len(q), top), -np.inf if exact else None, float if exact else object)
    ids = np.full((len(q), top), -1, np.int64)
    least = np.full(len(q), -np.inf)
    slack = 1e-9 * (q_norm[:, None].max() + c_norm.max()) + 1e-6
    q_whole, c_whole = (q, c) if exact else (np.vectorize(int, otypes=[object])(q), np.vectorize(int, otypes=[object])(c))
    for at in range(0, len(c), STEP):
        alive = np.arange(at, min(at + STEP, len(c)))
        for q_sum, c_sum in bounds:
            d = (q_sum * q_sum).sum(axis=1)[:, None] + (c_sum[alive] ** 2).sum(axis=1) - 2 * q_sum @ c_sum[alive].T
            cap = (q_norm[:, None] + c_norm[alive] - d) / 2
            alive = alive[(cap + slack >= least[:, None]).any(axis=0)]
            if not len(alive):
                break
        if not len(alive):
            continue
        found = q_whole @ c_whole[alive].T
        if not exact:
            found = np.clip(found, -(1 << 63), (1 << 63) - 1)
        own = q_ids[:, None] == c_ids[alive]
        rows = np.flatnonzero(((found > least[:, None]) & ~own).any(axis=1) if exact else np.ones(len(q), bool))
        for r in rows.tolist():
            keep = np.flatnonzero((found[r] > least[r]) & ~own[r]) if exact else np.flatnonzero(~own[r])
            # the ones so far have smaller ids: a stable order settles ties
            had = ids[r] >= 0 if exact else np.array([s is not None for s in scores[r]])
            s = np.concatenate([scores[r][had], found[r][keep]])
            i = np.concatenate([ids[r][had], c_ids[alive[keep]]])
            first = np.argsort(-s, kind="stable")[:top]
            scores[r, : len(first)], ids[r, : len(first)] = s[first], i[first]
            if len(first) == top and exact:
                least[r] = s[first[-1]]
    had = np.array([[s is not None and s != -np.inf for s in row] for row in scores]).reshape(scores.shape)
    return np.repeat(q_ids, had.sum(axis=1)), ids[had], scores[had]


def top_scores(vectors: DataFrame, queries: Column, top: int = TOP) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best candidates of every query row.

    ``vectors(vec_id, embedding)``; ``queries`` says of a row whether it is a
    query; candidates are all rows but the query's own.  Rows without vec_id
    and vectors that are null or hold null or non-finite components take no
    part.  Of rows that repeat a vec_id the smallest vector counts.  Vectors
    are compared with those of the same length.  Scores beyond a long count as
    its ends.  No rows give no rows.

    Queries and candidates are dealt into blocks by a hash, and each block of
    queries meets each block of candidates in a task of its own.
    """
    rows = written(vectors.filter(F.col("vec_id").isNotNull() & _finite(F.col("embedding")))
                   .groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("embedding"))
                   .select("vec_id", "embedding", F.coalesce(queries, F.lit(False)).alias("asks")), "vectors")
    n, asking = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    n_c, n_q = max(1, -(-n // CANDIDATES)), max(1, -(-asking // QUERIES))
    ordered = rows.withColumn("dim", F.size("embedding"))
    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    asked = ordered.filter("asks").select("vec_id", "embedding", "dim", F.pmod(F.xxhash64("vec_id", F.lit("q")), F.lit(n_q)).cast("int").alias("qb"), each(n_c).alias("cb"))
    given = ordered.select("vec_id", "embedding", "dim", F.pmod(F.xxhash64("vec_id"), F.lit(n_c)).cast("int").alias("cb"), each(n_q).alias("qb"))

    def whole(column: pd.Series) -> np.ndarray:
        return np.floor(SCALE * np.stack(column.to_numpy()).astype(np.float64)).reshape(len(column), -1)

    def compare(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        a, b, s = best_of_block(q["vec_id"].to_numpy(), whole(q["embedding"]), c["vec_id"].to_numpy(), whole(c["embedding"]), top)
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": pd.Series([int(x) for x in s], dtype="int64")})

    keys = ["qb", "cb", "dim"]
    found = asked.groupBy(*keys).cogroup(given.groupBy(*keys)).applyInPandas(compare, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the 5 best candidates of every vector whose vec_id is divisible by 50."""
    return top_scores(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT vec_id, unnest(e) AS c, unnest(range(len(e))) AS i FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.c * c.c)::BIGINT AS score
  FROM x q JOIN x c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""
