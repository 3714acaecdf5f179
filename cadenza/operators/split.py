"""Reproducible row-hash splits and fold assignment.

A row's part is a pure function of its key columns (md5 of the key text),
so the split is the same on every run, every partitioning and every
engine, and needs no shuffle: it is a filter on a computed column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key_cols: list[str], n: int, salt: str = "") -> Column:
    """``0 <= bucket < n`` from the first 32 bits of md5(key)."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    if salt:
        key = F.concat(F.lit(salt + "|"), key)
    h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return (h % n).cast("int")


def _bounds(weights: list[float], buckets: int) -> list[int]:
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    acc, out = 0.0, [0]
    for w in weights:
        acc += w
        out.append(round(buckets * acc / total))
    out[-1] = buckets
    for w, lo, hi in zip(weights, out, out[1:]):
        if w > 0 and lo == hi:
            raise ValueError(f"weight {w} of {total} rounds to none of {buckets} buckets; use more buckets")
    return out


def _in_range(b: Column, lo: int, hi: int, buckets: int) -> Column:
    # omit always-true bounds so the hash is evaluated once per row
    if lo <= 0:
        return b < hi if hi < buckets else F.lit(True)
    return b >= lo if hi >= buckets else (b >= lo) & (b < hi)


def hash_split(df: DataFrame, key_cols: list[str], weights: list[float] = (0.8, 0.2),
               salt: str = "", buckets: int = 100) -> list[DataFrame]:
    """Split into parts with the given weights (1/``buckets`` resolution).
    Parts are disjoint and together hold every row."""
    b = hash_bucket(key_cols, buckets, salt)
    lim = _bounds(list(weights), buckets)
    return [df.filter(_in_range(b, lim[i], lim[i + 1], buckets)) for i in range(len(weights))]


def with_part(df: DataFrame, key_cols: list[str], weights: list[float] = (0.8, 0.2),
              names: list[str] = ("train", "test"), salt: str = "", buckets: int = 100,
              col: str = "part") -> DataFrame:
    """Label each row with its part name instead of filtering."""
    b = hash_bucket(key_cols, buckets, salt)
    lim = _bounds(list(weights), buckets)
    expr = None
    for i, name in enumerate(names):
        cond = _in_range(b, lim[i], lim[i + 1], buckets)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(col, expr)


def with_fold(df: DataFrame, key_cols: list[str], k: int, salt: str = "fold",
              col: str = "fold") -> DataFrame:
    """Fold number ``0..k-1`` for cross-validation (salted so folds are
    independent of the train/test split)."""
    return df.withColumn(col, hash_bucket(key_cols, k, salt))
