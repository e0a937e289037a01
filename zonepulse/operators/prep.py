"""Projection, cleaning and time filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from zonepulse.functions.times import as_col_or_stamp


def conform(df: DataFrame, spec: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Select, cast and rename: {output: (input name or column, type)}."""
    return df.select(
        *[
            F.expr(f"CAST(`{src}` AS {dtype}) AS `{out}`") if isinstance(src, str) else src.cast(dtype).alias(out)
            for out, (src, dtype) in spec.items()
        ]
    )


def require_positive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose measures are all above zero; NULL fails."""
    return df.where(" AND ".join(f"`{c}` > 0" for c in cols))


def require_present(df: DataFrame, cols: Sequence[str], allow_empty: bool = False) -> DataFrame:
    test = "`{c}` IS NOT NULL" if allow_empty else "`{c}` IS NOT NULL AND CAST(`{c}` AS string) != ''"
    return df.where(" AND ".join(test.format(c=c) for c in cols))


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def time_range(df: DataFrame, col: str, start=None, end=None) -> DataFrame:
    """start <= col < end; either bound may be missing."""
    if start is not None:
        df = df.where(F.col(col) >= as_col_or_stamp(start))
    if end is not None:
        df = df.where(F.col(col) < as_col_or_stamp(end))
    return df


def date_between(df: DataFrame, ts: str, first, last) -> DataFrame:
    """Both days included. Compares the timestamp itself, so that a stored column is pruned
    at the scan; a cast to date would hide it from the file statistics."""
    first, last = _as_date(first), _as_date(last)
    return time_range(df, ts, first.isoformat(), (last + timedelta(days=1)).isoformat())


def _as_date(value) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def last_interval(
    df: DataFrame, col: str, interval: str, as_of=None, upper: bool = False
) -> DataFrame:
    """Rows within `interval` before `as_of` (default: the latest value, by scalar subquery).

    `upper` also drops rows after `as_of`.
    """
    end = df.agg(F.max(col)).scalar() if as_of is None else as_col_or_stamp(as_of)
    out = df.where(F.col(col) >= end - F.expr(f"interval {interval}"))
    return out.where(F.col(col) <= end) if upper else out


def same_year(df: DataFrame, ts: str, as_of) -> DataFrame:
    """Rows in the calendar year of `as_of`, as a range so that scans can prune."""
    year = _as_date(as_of).year
    return time_range(df, ts, f"{year}-01-01", f"{year + 1}-01-01")


def skip_warmup(df: DataFrame, ts: str, hours: int | None = None) -> DataFrame:
    """Drop the first `hours` of the whole set; off by default."""
    if hours is None:
        return df
    first = df.agg(F.min(ts)).scalar()
    return df.where(F.col(ts) >= first + F.expr(f"interval {hours} hours"))


def where_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Membership in a list that fits a literal; use where_exists for a table of keys."""
    return df.where(F.col(col).isin(list(values)))


def where_not(df: DataFrame, col: str, value) -> DataFrame:
    """Different from `value`; NULL is dropped as well."""
    return df.where(F.col(col) != F.lit(value))


def in_ranges(df: DataFrame, spec: Mapping[str, tuple[object, object]]) -> DataFrame:
    """Open ranges {column: (low, high)}; None leaves a side open."""
    for col, (low, high) in spec.items():
        if low is not None:
            df = df.where(F.col(col) > low)
        if high is not None:
            df = df.where(F.col(col) < high)
    return df


def preview(df: DataFrame, cols: Sequence[str], n: int) -> DataFrame:
    """Any n rows of some columns; fails early when a column is missing."""
    return df.select(*cols).limit(n)


def distinct_values(df: DataFrame, cols: Sequence[str], ordered: bool = False) -> DataFrame:
    out = df.select(*cols).distinct()
    return out.orderBy(*cols) if ordered else out


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name, duplicates kept."""
    for other in others:
        first = first.unionByName(other)
    return first


def with_columns(df: DataFrame, **cols: Column) -> DataFrame:
    return df.withColumns(cols)
