"""Dense-vector arithmetic on ``array<double>`` columns.

Vectors are plain arrays so Catalyst sees every operation; higher-order
functions (``zip_with``/``aggregate``/``transform``) run inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import ColumnOrName, _c


def _same_size(a: Column, b: Column, result: Column) -> Column:
    # zip_with would silently pad the shorter side with null.
    return F.when(F.size(a) == F.size(b), result).otherwise(
        F.raise_error(F.lit("vector sizes differ")))


def dot(a: ColumnOrName, b: ColumnOrName, check: bool = True) -> Column:
    """Inner product of two equal-length vectors."""
    a, b = _c(a), _c(b)
    r = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return _same_size(a, b, r) if check else r


UNROLL_MAX = 64


def dot_const(a: ColumnOrName, w: list[float]) -> Column:
    """Inner product with a fixed weight vector. Up to ``UNROLL_MAX`` weights
    it is unrolled into ``w0*a[0] + w1*a[1] + ...`` (plain arithmetic, fully
    code-generated); longer vectors use one ``aggregate(zip_with(...))`` over
    an array literal so the expression stays small. A null vector gives null,
    one of another size raises."""
    a = _c(a)
    expr = F.lit(0.0)
    if len(w) > UNROLL_MAX:
        wv = F.array(*[F.lit(float(x)) for x in w])
        expr = F.aggregate(F.zip_with(a, wv, lambda x, y: x * y), expr, lambda s, x: s + x)
    else:
        for i, wi in enumerate(w):
            expr = expr + F.lit(float(wi)) * F.get(a, i)
    return F.when(a.isNull(), None).when(F.size(a) == len(w), expr).otherwise(
        F.raise_error(F.lit("vector sizes differ")))


def scale(a: ColumnOrName, s: ColumnOrName | float) -> Column:
    """``a * s`` element-wise. A column ``s`` is evaluated inside the lambda
    for every element, so pass a stored column, not a costly expression."""
    s = F.lit(float(s)) if isinstance(s, (int, float)) else _c(s)
    return F.transform(_c(a), lambda x: x * s)


def add(a: ColumnOrName, b: ColumnOrName, check: bool = True) -> Column:
    """Element-wise sum of two equal-length vectors."""
    a, b = _c(a), _c(b)
    r = F.zip_with(a, b, lambda x, y: x + y)
    return _same_size(a, b, r) if check else r


def fill(size: int, value: ColumnOrName | float) -> Column:
    """Vector of ``size`` copies of ``value`` (a number or a column)."""
    v = F.lit(float(value)) if isinstance(value, (int, float)) else _c(value)
    return F.array_repeat(v.cast("double"), size)


def slice_indices(a: ColumnOrName, indices: list[int]) -> Column:
    """Pick elements in the given order (0-based), like a vector slicer."""
    a = _c(a)
    return F.array(*[F.get(a, i) for i in indices])


def sum_agg(a: ColumnOrName, size: int) -> list[Column]:
    """Element-wise sum over rows as ``size`` aggregate expressions
    (partial/final aggregation, no per-row arrays shipped)."""
    a = _c(a)
    return [F.sum(F.get(a, i)).alias(f"s{i}") for i in range(size)]


def sum_by(df, a: str, size: int, keys: list[str]):
    """Element-wise vector sums per key as long rows ``(keys..., i, s)``:
    ``size`` partial/final sums per key, then one row per element."""
    v = F.col(a)
    wide = df.groupBy(*keys).agg(*[F.sum(F.get(v, i)).alias(f"s{i}") for i in range(size)])
    return wide.select(*keys, F.posexplode(F.array(*[F.col(f"s{i}") for i in range(size)]))
                       .alias("i", "s"))
