"""Profiling operators: counts, range filters, min/max/mean, per-key counts,
first rows and top-1. Each returns a DataFrame (one plan, one scan); none
pulls rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_between(df: DataFrame, col: str, lo, hi, name: str = "n") -> DataFrame:
    """Rows with ``lo <= col <= hi`` (both bounds reach a parquet scan as
    pushed filters when ``col`` is a stored column)."""
    return df.filter(F.col(col).between(lo, hi)).agg(F.count(F.lit(1)).alias(name))


def count_where(df: DataFrame, conds: dict[str, Column]) -> DataFrame:
    """Several filtered counts in one pass: ``{name: predicate}``."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in conds.items()])


def column_profile(df: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """max, min, mean and the truncated integer mean of a numeric column in
    one aggregate. ``avg_*_trunc`` is ``sum div count`` over a 64-bit sum
    (the integer-division mean, without 32-bit overflow)."""
    p = prefix or col
    c = F.col(col)
    return df.agg(
        F.max(c).alias(f"max_{p}"),
        F.min(c).alias(f"min_{p}"),
        F.avg(c).alias(f"avg_{p}"),
        F.sum(c.cast("bigint")).cast("bigint").alias("_s"),
        F.count(c).alias("_n"),
    ).select(f"max_{p}", f"min_{p}", f"avg_{p}",
             F.expr("_s div _n").cast("bigint").alias(f"avg_{p}_trunc"))


def counts_by(df: DataFrame, key: str | list[str], where: Column | None = None,
              name: str = "count", order: bool = False) -> DataFrame:
    """``group by key`` counts (partial aggregation before the shuffle)."""
    keys = [key] if isinstance(key, str) else list(key)
    if where is not None:
        df = df.filter(where)
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(*keys) if order else out


def min_value(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Minimum as an aggregate (instead of a sort followed by first())."""
    return df.agg(F.min(col).alias(name or f"min_{col}"))


def first_rows(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows in a total order (a top-k, planned as
    TakeOrderedAndProject: per-partition top-n, then a merge of n rows each)."""
    return df.orderBy(*order_by).limit(n)


def top_row(df: DataFrame, order_by: list[str]) -> DataFrame:
    """The smallest row by the given keys (arrays compare lexicographically)."""
    return first_rows(df, 1, order_by)
