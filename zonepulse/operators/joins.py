"""Dimension joins, required joins, label lookups and grid completion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from zonepulse.functions.scalars import as_col, place_label, uniform


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    return fact.join(dim, on, how)


def join_date(fact: DataFrame, dim: DataFrame, ts, key: str = "full_date") -> DataFrame:
    """LEFT join on the day of a timestamp; the date key column of the dimension is dropped.

    A date that occurs twice in the dimension duplicates its facts.
    """
    return fact.join(dim, F.to_date(as_col(ts)) == dim[key], "left").drop(dim[key])


def join_role(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, take: str, role: str,
    how: str = "inner",
) -> DataFrame:
    """One role of a dimension used several times: bring column `take` in under the name `role`.

    The default drops facts without a match, which is what a LEFT join followed by a
    not-null filter on the key amounts to.
    """
    side = dim.select(F.col(dim_key).alias(f"__{role}_key"), F.col(take).alias(role))
    if how == "inner":
        side = side.where(F.col(role).isNotNull())
    return fact.join(side, fact[fact_key] == side[f"__{role}_key"], how).drop(f"__{role}_key")


def where_exists(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key occurs in `keys`. The keys are made distinct first: a hot key then
    crosses the network once per task instead of once per row."""
    return df.join(keys.select(on).distinct(), on, "left_semi")


def without_match(everything: DataFrame, present: DataFrame, on: str) -> DataFrame:
    """Rows whose key does not occur in `present`."""
    return everything.join(present.select(on).distinct(), on, "left_anti")


def label_locations(
    df: DataFrame, dim: DataFrame, key: str, zone: str = "zone_name", borough: str = "borough",
    out: str = "location",
) -> DataFrame:
    """Adds "<zone>, <borough>", or "Unknown Location" without a match."""
    names = dim.select(key, zone, borough).distinct()
    return df.join(names, key, "left").withColumn(out, place_label(zone, borough)).drop(zone, borough)


def complete_grid(
    df: DataFrame, key: str, period: str, periods: Sequence, value: str, fill="zero",
    bounds: tuple[float, float] = (0.8, 1.2), keys: Sequence | None = None,
    fallback: tuple[int, int] = (1000, 5000), seed: int | None = None,
) -> DataFrame:
    """One row per key and period; missing periods are filled, values end as whole numbers.

    fill: "zero", "mean" (mean of the key's present periods, cut to whole) or "random"
    (uniform between `bounds` times that mean; needs a seed). Keys listed in `keys` without
    any row use `fallback` as range. The grid comes from exploding the period list once per
    key, so it never crosses two tables.
    """
    if fill == "random" and seed is None:
        raise ValueError("a random fill needs a seed")
    ptype = dict(df.dtypes)[period]
    # Per key: the mean, and the present periods as a map bounded by the period list.
    inside = df.where(F.col(period).isin(list(periods)))
    present = inside.groupBy(key, period).agg(F.sum(value).alias(value))
    known = df.groupBy(key).agg(F.avg(value).alias("__mean"))
    if keys is not None:
        ktype = dict(df.dtypes)[key]
        wanted = F.explode(F.array(*[F.lit(k).cast(ktype) for k in keys]))
        listed = df.sparkSession.range(1).select(wanted.alias(key))
        known = listed.join(known, key, "left")
    slots = F.explode(F.array(*[F.lit(p).cast(ptype) for p in periods]))
    grid = known.select(key, "__mean", slots.alias(period))
    if fill == "zero":
        filler = F.lit(0)
    elif fill == "mean":
        filler = F.coalesce(F.floor("__mean"), F.lit((fallback[0] + fallback[1]) // 2))
    else:
        low = F.coalesce(F.floor(F.col("__mean") * bounds[0]), F.lit(fallback[0]))
        high = F.coalesce(F.floor(F.col("__mean") * bounds[1]), F.lit(fallback[1]))
        filler = low + F.floor(uniform(seed, key, period) * F.greatest(high - low, F.lit(1)))
    filled = F.coalesce(F.col(value), filler).cast("long").alias(value)
    return grid.join(present, [key, period], "left").select(key, period, filled)


def join_predictions(facts: DataFrame, predictions: DataFrame, on: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """INNER join on derived keys given as (name, fact column, prediction column).

    With keys coarser than the fact grain (cell, hour of day, weekday) a prediction reaches
    every past hour of the same kind, by design.
    """
    for name, left, right in on:
        facts = facts.withColumn(f"__{name}", left)
        predictions = predictions.withColumn(f"__{name}", right)
    names = [f"__{name}" for name, _, _ in on]
    keep = names + [c for c in predictions.columns if c.startswith("predicted_")]
    return facts.join(predictions.select(*keep), names, "inner").drop(*names)
