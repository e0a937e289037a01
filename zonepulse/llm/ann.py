"""Approximate nearest neighbours by inner product with an inverted multi-index.

Both halves of a vector are quantised on their own, so k centroids a half make k * k cells. A
query ranks the centroids of each half by their product with its own half, and walks the pairs
by falling sum with a heap until the cells hold enough vectors. The sum of the last pair then
tells which cells it has met. Vectors are dealt to parts by hash, so a cell that holds very many
is spread, and every part computes those of its vectors that lie in cells a query has met.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from zonepulse.llm.common import table
from zonepulse.session import stash

#: Centroids a half, vectors they are fitted on (in expectation), and the share of all vectors
#: that a query looks at. The given vectors lie almost evenly in all directions, where recall
#: needs so large a share; vectors in clusters need far less.
CENTROIDS = 96
FIT_ROWS = 16_384
LOOK_AT = 0.45
ROUNDS = 12
PART, QUERIES = 8_192, 4_096


@dataclass
class Index:
    """Centroids of both halves, and how many vectors each cell holds."""

    first: np.ndarray
    second: np.ndarray
    sizes: np.ndarray

    def cells(self, rows: np.ndarray) -> np.ndarray:
        cut = self.first.shape[1]
        return _nearest(rows[:, :cut], self.first) * len(self.second) + _nearest(rows[:, cut:], self.second)

    def sums(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return self.first @ query[:cut], self.second @ query[cut:]

    def walk(self, query: np.ndarray, look_at: float) -> float:
        """Sum of the last pair met, walking cells by falling sum until they hold `look_at` vectors.

        A single cell counts for at most an eighth of that, though all of it is looked at, so
        that copies of one vector do not use up a query's share.
        """
        one, two = self.sums(query)
        by_one, by_two = np.argsort(-one, kind="stable").tolist(), np.argsort(-two, kind="stable").tolist()
        down_one, down_two, sizes = one[by_one].tolist(), two[by_two].tolist(), self.sizes[np.ix_(by_one, by_two)].tolist()
        most, got, floor = look_at / 8, 0.0, np.inf
        heap, reach = [(-(down_one[0] + down_two[0]), 0, 0)], [0] * len(by_one)
        while heap and got < look_at:
            cost, i, j = heapq.heappop(heap)
            floor = -cost
            got += min(sizes[i][j], most)
            reach[i] = j + 1
            if j + 1 < len(by_two) and (i == 0 or reach[i - 1] > j + 1):
                heapq.heappush(heap, (-(down_one[i] + down_two[j + 1]), i, j + 1))
            if i + 1 < len(by_one) and reach[i + 1] == j:
                heapq.heappush(heap, (-(down_one[i + 1] + down_two[j]), i + 1, j))
        return floor


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)


def centroids(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k-means centres; starts are drawn far apart, with a fixed seed. Fewer if rows are few."""
    draw = np.random.default_rng(7)
    picks = [rows[draw.integers(len(rows))]]
    gap = ((rows - picks[0]) ** 2).sum(axis=1)
    while len(picks) < k and gap.max() > 0:
        picks.append(rows[draw.choice(len(rows), p=gap / gap.sum())])
        gap = np.minimum(gap, ((rows - picks[-1]) ** 2).sum(axis=1))
    centres = np.array(picks)
    for _ in range(rounds):
        at = _nearest(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, rows)
        n = np.bincount(at, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def fine_vectors(df: DataFrame, key: str = "vec_id", col: str = "embedding") -> DataFrame:
    """(vec_id, v) in double precision, one row per id.

    Vectors that are null, empty, all zero or hold null or non-finite components, and rows
    without id, are left out. Of rows with one id the smallest vector counts.
    """
    wide = F.transform(F.col(f"`{col}`"), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), wide.alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).groupBy("vec_id").agg(F.min("v").alias("v"))


def _stack(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float64)


def build(vectors: DataFrame, k: int = CENTROIDS, rows: int = FIT_ROWS) -> tuple[DataFrame, Index]:
    """Stored (vec_id, v, cell) of every vector, and the index. Centroids come from about `rows` vectors.

    All vectors must have one length.
    """
    n = vectors.count()
    share = min(1.0, rows / max(1, n))
    drawn = vectors.where(F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else vectors
    sample = np.array([r["v"] for r in drawn.select("vec_id", "v").orderBy("vec_id").collect()], np.float64)
    cut = sample.shape[1] // 2
    index = Index(centroids(sample[:, :cut], k), centroids(sample[:, cut:], k), np.zeros(0))

    def assign(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=index.cells(_stack(batch["v"])))

    cells = stash(vectors.mapInPandas(assign, "vec_id long, v array<double>, cell long"), "cells")
    index.sizes = np.zeros((len(index.first), len(index.second)), np.int64)
    for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():
        index.sizes[divmod(r["cell"], len(index.second))] = r["n"]
    return cells, index


def best_of(query_id: int, query: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple]:
    """The k best rows for a query. Scores are summed row by row, so equal vectors score the same."""
    rough = rows @ query
    some = np.flatnonzero(ids != query_id)
    if len(some) > k:
        edge = np.partition(rough[some], len(some) - k)[len(some) - k]
        some = some[rough[some] >= edge - 1e-9 * (1 + abs(edge))]
    scores = (rows[some] * query).sum(axis=1)
    best = np.lexsort((ids[some], -scores))[:k]
    return [(int(query_id), int(ids[some[i]]), float(scores[i])) for i in best]


def search(cells: DataFrame, index: Index, queries: DataFrame, k: int = 20, look_at: float = LOOK_AT) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found, ties to smaller ids.

    `queries` is (vec_id, v); a row with the query's id is no candidate. A query looks at a
    share `look_at` of all vectors or more, and at 25 * k at least. A task holds one part of the
    vectors and one block of queries.
    """
    n, asked = int(index.sizes.sum()), queries.count()
    parts = max(-(-n // PART), min(24, -(-n // 512)), 1)
    blocks = max(-(-asked // QUERIES), 1)
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))

    def visit(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(floor=[index.walk(np.asarray(v, np.float64), max(look_at * n, 25 * k)) for v in batch["v"]])

    walked = stash(queries.select("vec_id", "v").mapInPandas(visit, "vec_id long, v array<double>, floor double"), "walked")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    asked_rows = walked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "floor", block, every(parts).alias("part"))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part")
    held = cells.select("vec_id", "v", "cell", part, every(blocks).alias("block"))

    def compare(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(mine) and len(theirs):
            ids, rows = theirs["vec_id"].to_numpy(), _stack(theirs["v"])
            first, second = np.divmod(theirs["cell"].to_numpy(), len(index.second))
            for query_id, floor, query in zip(mine["query_id"], mine["floor"], _stack(mine["q"])):
                one, two = index.sums(query)
                met = np.flatnonzero(one[first] + two[second] >= floor - 1e-12)
                found += best_of(query_id, query, ids[met], rows[met], k)
        frame = pd.DataFrame(found, columns=["query_id", "vec_id", "score"])
        return frame.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["part", "block"]
    found = asked_rows.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(compare, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def is_query() -> Column:
    return F.col("vec_id") % 20 == 0


def op10_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    vectors = stash(fine_vectors(table(spark, folder, "embeddings")), "vectors")
    if vectors.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    cells, index = build(vectors)
    return search(cells, index, vectors.where(is_query()))
