"""Report orders, top-k and exact-size random samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonepulse.functions.scalars import DRAW_BITS, draw, lookup

#: A step of the selection looks at so many bits of the draws, from the highest on.
STEP_BITS = 12
STEPS = 3


def top_k(df: DataFrame, by: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*by).limit(k)


def order_by_category(
    df: DataFrame, col: str, order: Sequence[str], then: Sequence[Column], k: int | None = None
) -> DataFrame:
    """Rows in the order of a category list, then by `then`; unknown categories last."""
    rank = lookup(F.col(col), {name: i for i, name in enumerate(order)})
    out = df.orderBy(F.asc_nulls_last(rank), *then)
    return out.limit(k) if k else out


def random_n(df: DataFrame, n: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """Exactly n random rows (all rows if there are fewer), the same ones for the same seed.

    The rows with the n smallest draws of their keys. Radix selection finds how far those reach:
    a count per leading bits of the draws tells in which bucket the n-th smallest lies, a count
    inside that bucket tells it more closely. Each step is one aggregation of at most 2^12 rows
    and reads the keys only. After three steps one row in 2^36 shares the last bucket, so the
    sort that follows sees about n rows at any size.
    """
    rows = df.withColumn("__draw", draw(seed, *keys))
    # The draws below `floor` are taken, and `need` more are wanted from there on.
    floor, need = F.lit(0).cast("long"), F.lit(n).cast("long")
    for step in range(1, STEPS + 1):
        width = 1 << (DRAW_BITS - STEP_BITS * step)
        inside = rows.where((F.col("__draw") >= floor) & (F.col("__draw") < floor + (width << STEP_BITS)))
        bucket = F.shiftright(F.col("__draw") - floor, width.bit_length() - 1)
        counts = inside.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        # At most 2^12 rows reach the window without partitions.
        filled = counts.withColumn("before", F.sum("n").over(Window.orderBy("bucket")) - F.col("n"))
        last = filled.where(F.col("before") < need).agg(F.max_by(F.struct("bucket", "before"), "bucket")).scalar()
        floor, need = floor + F.coalesce(last["bucket"], F.lit(0)) * F.lit(width), need - F.coalesce(last["before"], F.lit(0))
    near = rows.where(F.col("__draw") < floor + width)
    return near.orderBy("__draw", *keys).drop("__draw").limit(n)
