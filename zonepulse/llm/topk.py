"""Exact top-k by integer inner product, pruned with segment statistics.

Vectors are cut into blocks and the queries are dealt to every block. In a block, means and
deviations of a few segments bound each inner product from above (for centred segments the
product is at most the product of their deviations), first on coarse, then on finer segments;
only survivors are computed. Each block gives k rows a query, of which the best k remain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from zonepulse.llm.common import table
from zonepulse.session import stash

LEVELS = (4, 16)
BLOCK = 8_192
QUERIES = 4_096
RESULT = "query_id long, vec_id long, score long, computed long"


def whole_vectors(df: DataFrame, key: str = "vec_id", col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v) with floor(scale * x) of each component, one row per id.

    Vectors that are null or hold null or non-finite components, and rows without id, are left
    out. Of rows with one id the smallest vector counts. Components must fit a long.
    """
    wide = F.transform(F.col(f"`{col}`"), lambda x: x.cast("double"))
    fine = F.forall("w", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), wide.alias("w"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    floors = F.transform("w", lambda x: F.floor(x * scale).cast("long"))
    return rows.select("vec_id", floors.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def segment_features(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of segments, scaled so that the dot product of two rows' features bounds theirs."""
    parts = np.array_split(np.arange(rows.shape[1]), min(segments, max(rows.shape[1], 1)))
    out = []
    for part in parts:
        piece = rows[:, part].astype(np.float64)
        root = np.sqrt(len(part))
        out += [piece.mean(axis=1) * root, piece.std(axis=1) * root] if len(part) else []
    return np.stack(out, axis=1) if out else np.zeros((len(rows), 1))


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple]:
    """Best k rows of a block for each query: (query, id, score, products computed)."""
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most >= 1 << 62:
        raise ValueError("inner products exceed a long")
    levels = [(segment_features(queries, n), segment_features(rows, n)) for n in LEVELS]
    slack = 1e-9 * np.linalg.norm(queries.astype(np.float64), axis=1) * np.linalg.norm(rows.astype(np.float64), axis=1).max(initial=0) + 1e-3
    coarse = levels[0][0] @ levels[0][1].T
    out = []
    for n, query in enumerate(queries):
        bound = np.where(ids == query_ids[n], -np.inf, coarse[n])
        left = np.flatnonzero(bound > -np.inf)
        computed = 0
        if len(left) > k:
            seed = left[np.argpartition(-bound[left], k - 1)[:k]]
            floor = (rows[seed] @ query).min() - slack[n]
            computed += len(seed)
            left = left[bound[left] >= floor]
            for mine, theirs in levels[1:]:
                left = left[theirs[left] @ mine[n] >= floor]
        scores = rows[left] @ query
        computed += len(left)
        best = np.lexsort((ids[left], -scores))[:k]
        out += [(int(query_ids[n]), int(ids[left[i]]), int(scores[i]), computed) for i in best]
    return out


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest inner products, ties to smaller ids.

    Both inputs are (vec_id, v) with whole components; vectors meet only those of their own
    length. A row with the query's id is no candidate. A task holds one block of rows and one
    block of queries, whatever their numbers. No queries or no rows give no result.
    """
    n, asked = vectors.count(), queries.count()
    blocks = max(-(-n // block), min(48, -(-n // 256)), 1)
    groups = max(-(-asked // query_block), 1)
    slot = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = queries.select(F.col("vec_id").alias("ask"), F.col("v").alias("asked"), F.size("v").alias("dim"), group.alias("grp"), every(blocks).alias("slot"))
    right = vectors.select(F.col("vec_id").alias("id"), F.col("v").alias("row"), F.size("v").alias("dim"), slot.alias("slot"), every(groups).alias("grp"))

    def search(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(mine) and len(theirs):
            stack = lambda c: np.stack(c.to_numpy()).astype(np.int64)
            rows = search_block(mine["ask"].to_numpy(), stack(mine["asked"]), theirs["id"].to_numpy(), stack(theirs["row"]), k)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score", "computed"], dtype="int64")

    keys = ["dim", "grp", "slot"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_segment_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = stash(whole_vectors(table(spark, folder, "embeddings")), "vectors")
    return exact_top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


SQL = {
    "op6_segment_top_k": """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
}
