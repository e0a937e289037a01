"""Data checks. Each returns the violations, or a frame that counts them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return df.where(bad)


def check_reference(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Facts whose key is set but missing from the dimension."""
    keys = dim.select(F.col(dim_key).alias(fact_key)).distinct()
    return fact.where(F.col(fact_key).isNotNull()).join(keys, fact_key, "left_anti")


def check_range(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that fail the condition; rows where it is unknown pass, as in SQL checks."""
    return df.where(~condition)


def check_schema(df: DataFrame, expected: StructType, exact: bool = False) -> list[str]:
    """Differences as text, empty when the schema fits."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in expected}
    problems = [f"missing column {name}" for name in want if name not in have]
    problems += [
        f"column {name} is {have[name]}, not {want[name]}"
        for name in want
        if name in have and have[name] != want[name]
    ]
    if exact:
        problems += [f"unexpected column {name}" for name in have if name not in want]
    return problems


def report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: how many violations, and whether it passed."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        for name, df in checks.items()
    ]
    out = reduce(DataFrame.unionByName, counted)
    return out.withColumn("passed", F.col("violations") == 0)


def violations(conditions: Mapping[str, Column]) -> dict[str, Column]:
    """Aggregates that count the rows that fail each condition, to be had in one pass."""
    return {name: F.count(F.when(~good, 1)) for name, good in conditions.items()}


def known(df: DataFrame, references: Mapping[str, tuple[str, DataFrame, str]]) -> tuple[DataFrame, dict[str, Column]]:
    """Rows tagged by left joins, and the conditions that say whether their keys are known.

    References are {check: (key, dimension, its key)}; an unknown key counts, a missing one does
    not. Each dimension is reduced to its keys, so no row is repeated, and all checks of a table
    then share one pass over it.
    """
    conditions = {}
    for n, (name, (key, dim, dim_key)) in enumerate(references.items()):
        tag = f"__known_{n}"
        keys = dim.select(F.col(dim_key).alias(f"__key_{n}")).distinct().withColumn(tag, F.lit(True))
        df = df.join(keys, F.col(key) == F.col(f"__key_{n}"), "left").drop(f"__key_{n}")
        conditions[name] = F.col(key).isNull() | F.col(tag).isNotNull()
    return df, conditions


def counted_report(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """The report of violations that were counted elsewhere."""
    rows = [(name, int(n or 0), not n) for name, n in counts.items()]
    return spark.createDataFrame(rows, "check_name string, violations long, passed boolean")


def condition_report(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Row-wise checks counted in a single pass; a condition holds for good rows."""
    names = list(conditions)
    counts = df.agg(*[col.alias(f"c{i}") for i, col in enumerate(violations(conditions).values())])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(names)]))
    out = counts.select(pairs.alias("p")).select("p.check_name", "p.violations")
    return out.withColumn("passed", F.col("violations") == 0)
