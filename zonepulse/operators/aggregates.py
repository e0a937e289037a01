"""Grouped and whole-set aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from zonepulse.functions.scalars import as_col
from zonepulse.functions.times import dow, hour_floor, month_key
from zonepulse.operators.prep import last_interval

MONEY = "decimal(18,4)"
WIDE = "decimal(28,9)"  # for measured and computed values


def exact_sum(col, dtype: str) -> Column:
    """Sum in decimals, as double: the order of the rows cannot change it. The type says how many
    digits count: `MONEY` for amounts, `WIDE` for measured and computed values."""
    return F.sum(as_col(col).cast(dtype)).cast("double")


def exact_avg(col, dtype: str) -> Column:
    return exact_sum(col, dtype) / F.count(as_col(col))


def mean_where(condition, value) -> Column:
    return F.avg(F.when(as_col(condition), as_col(value)))


def hourly_counts(df: DataFrame, cell: str, ts: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows per cell and hour. Partial counts run before the shuffle, so a hot cell sends at
    most one row per hour and task."""
    more = [col.alias(name) for name, col in (extra or {}).items()]
    return df.groupBy(cell, hour_floor(ts).alias("timestamp_hour")).agg(
        F.count(F.lit(1)).alias("total_pickups"), *more
    )


VOLUME_KEYS = {
    "hour": lambda ts: F.hour(as_col(ts)),
    "day_of_week": dow,
    "month": month_key,
}


def volume_by(
    df: DataFrame, key: str, ts: str, period: str, out: str = "trip_count", weight: str | None = None
) -> DataFrame:
    """Rows per key and period; period is hour, day_of_week or month. `weight` names a column
    of counts when the rows are themselves sums."""
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(key, VOLUME_KEYS[period](ts).alias(period)).agg(rows.alias(out))


def coverage(df: DataFrame, key: str, ts: str) -> DataFrame:
    """One row: how many rows and keys, and the time they span."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(key).alias("key_count"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named frame, counted in one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("model"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def kpis(df: DataFrame, value: str, key: str | None = None, dtype: str = WIDE) -> DataFrame:
    """Count, sum, mean and max of a column, and the number of keys."""
    out = [
        F.count(F.lit(1)).alias("row_count"),
        exact_sum(value, dtype).alias("total"),
        exact_avg(value, dtype).alias("mean"),
        F.max(value).alias("maximum"),
    ]
    if key:
        out.append(F.count_distinct(key).alias("key_count"))
    return df.agg(*out)


def value_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), F.asc(col))


def avg_or_default(df: DataFrame, value: str, default: float, out: str) -> DataFrame:
    """One row even for an empty input."""
    return df.agg(F.coalesce(exact_avg(value, WIDE), F.lit(float(default))).alias(out))


def density(df: DataFrame, cell: str, area_km2: float, k: int | None = None) -> DataFrame:
    """Rows per cell and per square km, densest first."""
    out = df.groupBy(cell).agg(F.count(F.lit(1)).alias("trips"))
    out = out.withColumn("trips_per_km2", F.col("trips") / F.lit(area_km2))
    out = out.orderBy(F.desc("trips_per_km2"), F.asc(cell))
    return out.limit(k) if k else out


def rollup_cells(df: DataFrame, parent: Column, sums: Mapping[str, str], means: Mapping[str, str]) -> DataFrame:
    """Sums and means of finer cells under their parent: {output: input}."""
    aggs = [F.sum(src).alias(out) for out, src in sums.items()]
    aggs += [exact_avg(src, WIDE).alias(out) for out, src in means.items()]
    return df.groupBy(parent.alias("parent_cell")).agg(F.count(F.lit(1)).alias("cells"), *aggs)


def realtime_summary(
    df: DataFrame, key: str, ts: str, demand: str, surge: str, interval: str = "1 hour", as_of=None
) -> DataFrame:
    """Per key over the last interval: mean demand, mean multiplier, rows, latest update."""
    return last_interval(df, ts, interval, as_of).groupBy(key).agg(
        exact_avg(demand, WIDE).alias("avg_demand"),
        exact_avg(surge, WIDE).alias("avg_surge"),
        F.count(F.lit(1)).alias("n"),
        F.max(ts).alias("last_updated"),
    )


def mape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute percentage error; rows with a zero actual do not count."""
    actual, predicted = F.col(actual).cast("double"), F.col(predicted).cast("double")
    ratio = F.abs(actual - predicted) / F.nullif(F.abs(actual), F.lit(0.0))
    return df.agg((F.avg(ratio) * 100.0).alias("mape"), F.count(ratio).alias("rows_scored"))


def net_balance(df: DataFrame, key: str, kind: str, start: Sequence, end: Sequence, out: str = "active") -> DataFrame:
    """Starts minus ends per key; the same grouping serves batch and streams."""
    step = F.when(F.col(kind).isin(list(start)), 1).when(F.col(kind).isin(list(end)), -1).otherwise(0)
    return df.groupBy(key).agg(F.sum(step).cast("long").alias(out))
