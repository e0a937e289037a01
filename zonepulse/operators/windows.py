"""Series features, quantile scores, ranks and whole-set scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonepulse.session import stash


def series_features(
    df: DataFrame, key: str, order: str | Sequence[str], value: str,
    lags: Mapping[str, int], rolls: Mapping[str, int], block_rows: int | None = None,
) -> DataFrame:
    """Adds lags {name: n rows back} and rolling means {name: n rows} of `value` per key.

    Both count rows, not time: a gap in the series moves "24 back" further into the past, and
    frames at the start average what is there.

    All features share one sort per key. That fits a pre-aggregated series, whose keys hold at
    most one row per hour of the calendar. For series with unbounded keys pass `block_rows`:
    the rows of a key are then numbered, cut into blocks of that many rows, and each block is
    computed on its own together with a copy of the few rows before it. Results are the same.
    """
    halo = max([*lags.values(), *[n - 1 for n in rolls.values()], 1])
    order = [order] if isinstance(order, str) else list(order)

    def features(w) -> dict[str, Column]:
        out = {name: F.lag(value, n).over(w) for name, n in lags.items()}
        for name, n in rolls.items():
            out[name] = F.avg(value).over(w.rowsBetween(-(n - 1), Window.currentRow))
        return out

    if block_rows is None:
        return df.withColumns(features(Window.partitionBy(key).orderBy(*order)))
    if block_rows < halo:
        raise ValueError(f"block_rows must be at least {halo}")
    block = F.floor(F.col("__pos") / block_rows)
    tail = F.col("__pos") % block_rows >= block_rows - halo
    copies = F.when(tail, F.array(block, block + 1)).otherwise(F.array(block))
    spread = number_rows(df, key, order, "__pos").withColumn("__block", F.explode(copies))
    done = spread.withColumns(features(Window.partitionBy(key, "__block").orderBy("__pos")))
    return done.where(F.col("__block") == block).drop("__pos", "__block")


def sorted_parts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows in global order, stored once, with their part and their place in it.

    Ranges are cut by sampling on all of `by`, so a value that fills many parts is spread over
    them by the columns after it. Stored, because counting and using the places must see the
    same parts.
    """
    places = {
        "__part": F.spark_partition_id(),
        "__place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    }
    return stash(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumns(places), "sorted")


def number_rows(df: DataFrame, key: str, order: Sequence[str], out: str) -> DataFrame:
    """Position of each row within its key (from 0) without a task ever holding a whole key.

    A key's rows lie in consecutive parts; only their counts per part are added up.
    """
    parts = sorted_parts(df, [key, *order])
    earlier = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        parts.groupBy(key, "__part")
        .agg(F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__first"))
        .select(key, "__part", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"))
    )
    matched = parts.withColumnRenamed(key, "__key").join(
        spans, F.col("__key").eqNullSafe(F.col(key)) & (parts["__part"] == spans["__part"])
    )
    return matched.select(*df.columns, (F.col("__place") + F.col("__shift")).alias(out))


def add_change(df: DataFrame, value: str, lag: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(value) - F.col(lag))


def quantile_scores(df: DataFrame, scores: Mapping[str, str], n: int, tiebreak: str | Sequence[str]) -> DataFrame:
    """NTILE(n) over the whole set for each {output: column}, ascending, ties by `tiebreak`.

    Rows are numbered over a distributed sort, at every size; a bucket follows from a row's
    number. Bucket sizes are NTILE's even if rows are alike in column and tiebreak; which of
    those comes first is then open, so name columns that tell rows apart.
    """
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    for out, col in scores.items():
        df = _scored(df, [col, *(t for t in ties if t != col)], n, out)
    return df


def _scored(df: DataFrame, by: Sequence[str], n: int, out: str) -> DataFrame:
    parts = sorted_parts(df, by)
    counts = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__first"))
    in_order = Window.orderBy("__part")
    # One row per range of the sort.
    spans = counts.select(
        "__part",
        (F.coalesce(F.sum("__n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__total"),
    )
    total = F.col("__total")
    place, size = F.col("__place") + F.col("__shift"), F.floor(total / n)
    larger = (total % n) * (size + 1)
    bucket = F.when(place < larger, F.floor(place / (size + 1)))
    bucket = bucket.otherwise(total % n + F.floor((place - larger) / F.greatest(size, F.lit(1))))
    return parts.join(F.broadcast(spans), "__part").select(*df.columns, (bucket + 1).cast("int").alias(out))


def top_n_per_group(df: DataFrame, group: str, by: Sequence[Column], n: int) -> DataFrame:
    """The first n rows per group. Spark cuts each task to n rows per group before the shuffle."""
    w = Window.partitionBy(group).orderBy(*by)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def name_by_rank(df: DataFrame, group: str, metric: str, names: Sequence[str], out: str) -> DataFrame:
    """Names groups by falling mean of `metric`; groups beyond the names stay NULL."""
    by = [F.desc("__mean"), F.asc(group)]
    table = F.array(*[F.lit(name) for name in names])
    # Only as many groups as there are names reach the window without partitions.
    best = df.groupBy(group).agg(F.avg(metric).alias("__mean")).orderBy(*by).limit(len(names))
    ranked = best.select(group, F.get(table, F.row_number().over(Window.orderBy(*by)) - 1).alias(out))
    # Sent to every task: at most len(names) rows, by the limit above.
    return df.join(F.broadcast(ranked), group, "left")


def min_max(df: DataFrame, col: str, out: str, low: float = 0.0, high: float = 100.0) -> DataFrame:
    """Linear scaling of the whole column to [low, high]; a constant column becomes `low`."""
    least, most = df.agg(F.min(col)).scalar(), df.agg(F.max(col)).scalar()
    ratio = F.coalesce(F.try_divide(F.col(col) - least, most - least), F.lit(0.0))
    return df.withColumn(out, F.lit(low) + ratio * F.lit(high - low))


def share_of_max(df: DataFrame, col: str, out: str, scale: float = 100.0) -> DataFrame:
    most = df.agg(F.max(col)).scalar().cast("double")
    return df.withColumn(out, F.try_divide(F.col(col).cast("double"), most) * scale)


def with_max(df: DataFrame, col: str, out: str) -> DataFrame:
    """The largest value of the whole set next to every row."""
    return df.withColumn(out, df.agg(F.max(col)).scalar())


def correlation_sign(df: DataFrame, a: str, b: str) -> Column:
    """-1 where the two columns fall together oppositely, else 1; a scalar for the whole set."""
    corr = df.agg(F.corr(a, F.col(b).cast("double"))).scalar()
    return F.when(corr < 0, F.lit(-1.0)).otherwise(F.lit(1.0))


