"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from zonepulse.operators.windows import sorted_parts
from zonepulse.session import stash


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def number_all(df: DataFrame, by: Sequence[str], out: str) -> tuple[DataFrame, int]:
    """Position of every row (from 0) in the order of `by`, and the number of rows.

    Rows are dealt by sampled ranges over all of `by`, so a value that many rows share is
    spread by the columns after it. Only one count per range is summed up in one task.
    """
    parts = sorted_parts(df, by)
    counts = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__first"))
    counts = stash(counts, "ranges")
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n")).first()["n"]
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.select(
        "__part", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift")
    )
    # One row per range of the sort, a few hundred bytes for each task of the cluster.
    placed = parts.join(F.broadcast(spans), "__part")
    return placed.select(*df.columns, (F.col("__place") + F.col("__shift")).alias(out)), total


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(id, comp) of every id that `edges` (a, b) link to a smaller one: comp is the smallest.

    An id that is not in the result is its own component. `labels`, an earlier result, is
    carried on: only the new edges are followed. Each round hooks every component to its
    smallest neighbour, follows the hooks to their end and keeps only the edges between
    components that are still apart. All of it stays in tables; each round is written to the
    shared folder, which cuts the lineage.
    """

    def apart(rows: DataFrame, to: DataFrame | None) -> DataFrame:
        """Edges (lo, hi) between the components that `to` (id, comp) names."""
        a, b = F.col("a"), F.col("b")
        if to is not None:
            left = to.select(F.col("id").alias("a"), F.col("comp").alias("to_a"))
            right = to.select(F.col("id").alias("b"), F.col("comp").alias("to_b"))
            rows = rows.join(left, "a", "left").join(right, "b", "left")
            a, b = F.coalesce("to_a", "a"), F.coalesce("to_b", "b")
        return stash(rows.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi"), "edges")

    edges = apart(edges, labels)
    if labels is None:
        labels = edges.select(F.col("hi").alias("id"), F.col("lo").alias("comp")).where(F.lit(False))
    while not edges.isEmpty():
        hooks = stash(edges.groupBy(F.col("hi").alias("id")).agg(F.min("lo").alias("comp")), "hooks")
        while True:
            above = hooks.select(F.col("id").alias("comp"), F.col("comp").alias("top"))
            jumped = hooks.join(above, "comp", "left")
            if jumped.where("top IS NOT NULL").isEmpty():
                break
            hooks = stash(jumped.select("id", F.coalesce("top", "comp").alias("comp")), "hooks")
        to = hooks.select(F.col("id").alias("comp"), F.col("comp").alias("top"))
        moved = labels.join(to, "comp", "left").select("id", F.coalesce("top", "comp").alias("comp"))
        labels = stash(moved.unionByName(hooks), "labels")
        edges = apart(edges.select(F.col("lo").alias("a"), F.col("hi").alias("b")), hooks)
    return labels
