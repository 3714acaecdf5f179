"""Feature pipeline stages as ``pyspark.ml`` Transformers/Estimators.

Each stage is a column expression over ``array<double>`` vectors, so a whole
pipeline collapses into one projection that Catalyst can prune and codegen.
``ToMLVector`` converts to MLlib's vector type only at the edge, for MLlib
estimators.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import _regex_literal


SIZE_KEY = "vector_size"  # column metadata: fixed length of an array<double> vector


def with_vector(df: DataFrame, name: str, expr: Column, size: int | None) -> DataFrame:
    """Add a vector column, recording its length in the column metadata so
    estimators need no job to discover it."""
    out = df.withColumn(name, expr)
    return out.withMetadata(name, {SIZE_KEY: size}) if size is not None else out


class _Stage(HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    def _in(self) -> Column:
        return F.col(self.getInputCol())


class Tokenizer(Transformer, _Stage):
    """Split on a regex, lower-case, drop tokens shorter than
    ``minTokenLength`` (empty ones by default). An empty field therefore
    disappears and shifts later tokens, exactly like a gap tokenizer."""

    pattern = Param(Params._dummy(), "pattern", "regex separating tokens",
                    typeConverter=TypeConverters.toString)
    toLowercase = Param(Params._dummy(), "toLowercase", "lower-case first",
                        typeConverter=TypeConverters.toBoolean)
    minTokenLength = Param(Params._dummy(), "minTokenLength", "minimum token length",
                           typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="value", outputCol="tokens", pattern="\\s+",
                 toLowercase=True, minTokenLength=1):
        super().__init__()
        self._setDefault(pattern="\\s+", toLowercase=True, minTokenLength=1)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self._in()
        if self.getOrDefault(self.toLowercase):
            s = F.lower(s)
        k = self.getOrDefault(self.minTokenLength)
        pattern = self.getOrDefault(self.pattern)
        parts = F.split(s, pattern, -1)
        if k == 1:
            # dropping only empty tokens: a code-generated built-in
            toks = F.array_remove(parts, "")
        elif k <= 0:
            # keep empty tokens except trailing ones, like a JVM regex split
            # (a line of only separators has no tokens)
            stripped = F.regexp_replace(s, f"(?:{pattern})+$", "")
            toks = F.when((stripped == "") & (s != ""), F.array().cast("array<string>")) \
                    .otherwise(F.split(stripped, pattern, -1))
        else:
            toks = F.filter(parts, lambda t: F.length(t) >= k)
        return df.withColumn(self.getOutputCol(), toks)


class ArrayToVector(Transformer, _Stage):
    """``array<string>`` (or any numeric array) -> ``array<double>``."""

    @keyword_only
    def __init__(self, inputCol="tokens", outputCol="tokens_vector"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), self._in().cast("array<double>"))


class VectorSlicer(Transformer, _Stage):
    """Pick vector elements by 0-based index, in the order given. An index
    outside a vector raises (at once where the column's size is known, else
    per row); a null vector gives a null one."""

    indices = Param(Params._dummy(), "indices", "0-based indices",
                    typeConverter=TypeConverters.toListInt)

    @keyword_only
    def __init__(self, inputCol="tokens_vector", outputCol="features", indices=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self._in()
        idx = self.getOrDefault(self.indices)
        size = df.schema[self.getInputCol()].metadata.get(SIZE_KEY)
        if any(i < 0 or (size is not None and i >= int(size)) for i in idx):
            raise ValueError(f"indices {idx} are outside a vector of size {size}")
        picked = F.array(*[F.get(v, i) for i in idx])
        out = F.when(v.isNull(), None).when(F.size(v) > max(idx, default=-1), picked).otherwise(
            F.raise_error(F.lit(f"a vector has no element {max(idx, default=-1)}")))
        return with_vector(df, self.getOutputCol(), out, len(idx))


class ColumnFn(Transformer, _Stage):
    """A user function ``Column -> Column`` as a stage (the function stays a
    Catalyst expression, unlike an opaque UDF)."""

    def __init__(self, fn: Callable[[Column], Column], inputCol: str, outputCol: str):
        super().__init__()
        self.fn = fn
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), self.fn(self._in()))

    def copy(self, extra=None):
        that = ColumnFn(self.fn, self.getInputCol(), self.getOutputCol())
        return self._copyValues(that, extra)

    def write(self):
        raise NotImplementedError("ColumnFn holds a Python function and cannot be saved; "
                                  "rebuild it in code after loading the other stages")


class PandasArrayFn(Transformer, _Stage):
    """Arbitrary Python over vectors, vectorised: ``fn`` receives a batch as a
    2-D NumPy matrix (rows x size) and returns one double per row. Runs as an
    Arrow UDF; prefer :class:`ColumnFn` when the function can
    be written with column expressions."""

    def __init__(self, fn: Callable, inputCol: str, outputCol: str):
        super().__init__()
        self.fn = fn
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        fn = self.fn

        @F.arrow_udf("double")
        def apply(a: pa.Array) -> pa.Array:
            # the list column flattens to one matrix, with no Python object per row
            sizes = pc.unique(pc.list_value_length(a)).to_pylist()
            if len(sizes) > 1 or None in sizes:
                raise ValueError(f"vectors must be non-null and of one size, found sizes {sizes}")
            m = a.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(a), -1)
            return pa.array(np.asarray(fn(m), dtype=float)) if len(a) else pa.array([], pa.float64())

        return df.withColumn(self.getOutputCol(), apply(self._in()))

    def copy(self, extra=None):
        that = PandasArrayFn(self.fn, self.getInputCol(), self.getOutputCol())
        return self._copyValues(that, extra)

    def write(self):
        raise NotImplementedError("PandasArrayFn holds a Python function and cannot be "
                                  "saved; rebuild it in code after loading the other stages")


class FlatMapFn(Transformer, _Stage):
    """A user function from one value to any number of rows, as a stage.

    ``fn`` is called once per row with the input column's value and gives an
    iterable of outputs of type ``schema`` (DDL). A generator is consumed as it
    goes, and rows are handed on in batches of ``batchRows``, so neither a row with
    very many outputs nor a large input batch is held whole. All other columns
    are carried; columns named like the output or ``positionCol`` (the output's
    number within its row, from 0) are replaced. No output, or None for it, gives
    no row; with ``outer`` one row whose output and position are null.
    """

    def __init__(self, fn: Callable, inputCol: str, outputCol: str, schema: str, positionCol: str | None = None,
                 outer: bool = False, batchRows: int = 4096):
        super().__init__()
        self.fn, self.schema, self.positionCol, self.outer, self.batchRows = fn, schema, positionCol, outer, batchRows
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.sql.pandas.types import to_arrow_type
        from pyspark.sql.types import LongType, StructField, StructType, _parse_datatype_string
        fn, outer, limit, position = self.fn, self.outer, self.batchRows, self.positionCol
        # a bare type ("string") as well as a struct of fields
        kind = _parse_datatype_string(self.schema)
        arrow = to_arrow_type(kind)
        new = [self.getOutputCol(), *([position] if position else [])]
        carried = [f for f in df.schema.fields if f.name.lower() not in {n.lower() for n in new}]
        names = [f"c{i}" for i in range(len(carried))]  # duplicate and odd names travel as numbers

        def run(batches):
            for batch in batches:
                at, places, values = [], [], []

                def out():
                    rows = batch.take(pa.array(at, pa.int64()))
                    made = pa.RecordBatch.from_arrays(
                        [*rows.columns[1:], pa.array(places, pa.int64()), pa.array(values, arrow)], names=[*names, "place", "value"])
                    for x in (at, places, values):
                        x.clear()
                    return made

                for i in range(batch.num_rows):
                    some = False
                    for k, v in enumerate(fn(batch.column(0)[i].as_py()) or ()):
                        some = True
                        at.append(i)
                        places.append(k)
                        values.append(v)
                        if len(at) >= limit:
                            yield out()
                    if outer and not some:
                        at.append(i)
                        places.append(None)
                        values.append(None)
                        if len(at) >= limit:
                            yield out()
                if at:
                    yield out()

        fields = [StructField(n, f.dataType) for n, f in zip(names, carried)]
        source = df.select(self._in().alias("input"), *(F.col(f"`{f.name}`").alias(n) for n, f in zip(names, carried)))
        rows = source.mapInArrow(run, StructType([*fields, StructField("place", LongType()), StructField("value", kind)]))
        return rows.select(*(F.col(n).alias(f.name, metadata=f.metadata) for n, f in zip(names, carried)),
                           *([F.col("place").alias(position)] if position else []), F.col("value").alias(self.getOutputCol()))

    def copy(self, extra=None):
        that = FlatMapFn(self.fn, self.getInputCol(), self.getOutputCol(), self.schema, self.positionCol, self.outer, self.batchRows)
        return self._copyValues(that, extra)

    def write(self):
        raise NotImplementedError("FlatMapFn holds a Python function and cannot be saved; "
                                  "rebuild it in code after loading the other stages")


class ElementToDouble(Transformer, _Stage):
    """One vector element as a ``double`` column (default element 0)."""

    index = Param(Params._dummy(), "index", "element index", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="year", outputCol="label", index=0):
        super().__init__()
        self._setDefault(index=0)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(),
                             F.get(self._in(), self.getOrDefault(self.index)).cast("double"))


class _MinShiftParams(_Stage):
    offset = Param(Params._dummy(), "offset", "value subtracted from the input",
                   typeConverter=TypeConverters.toFloat)


class MinShift(Estimator, _MinShiftParams):
    """Learn the minimum of the input column (one aggregate) and subtract it,
    so the smallest value becomes 0. Passing ``offset`` fixes the constant
    instead of learning it."""

    @keyword_only
    def __init__(self, inputCol="label", outputCol="label_shifted", offset=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def isFixed(self) -> bool:
        """Is the constant given, so that nothing is learned?"""
        return self.isSet(self.offset)

    def learned(self, minimum: float | None) -> "MinShiftModel":
        """The fitted stage, given the minimum of its input."""
        if minimum is None:
            raise ValueError("MinShift: empty input, no minimum to learn")
        model = MinShiftModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
                              offset=float(minimum))
        return self._copyValues(model)

    def _fit(self, df: DataFrame) -> "MinShiftModel":
        return self.learned(self.getOrDefault(self.offset) if self.isFixed() else df.agg(F.min(self._in())).first()[0])


class MinShiftModel(Model, _MinShiftParams):
    @keyword_only
    def __init__(self, inputCol="label", outputCol="label_shifted", offset=0.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(),
                             self._in() - F.lit(self.getOrDefault(self.offset)))


def poly_terms(n: int, degree: int) -> list[tuple[int, ...]]:
    """Exponent tuples of all monomials of total degree 1..degree over ``n``
    variables, in the order MLlib's PolynomialExpansion emits them: the
    last variable's power is the outer loop, recursing on the earlier ones
    (for (x, y, z), degree 2: x, x², y, xy, y², z, xz, yz, z²)."""

    def rec(last: int, deg: int) -> list[tuple[int, ...]]:
        if last < 0:
            return [()]
        out = []
        for p in range(deg + 1):
            for head in rec(last - 1, deg - p):
                out.append(head + (p,))
        return out

    return [t for t in rec(n - 1, degree) if sum(t) > 0]


class PolyExpansion(Transformer, _Stage):
    """Degree-``d`` polynomial expansion of an ``array<double>`` vector
    (constant term dropped). The input size comes from ``numFeatures``, else
    from the input column's metadata (set by the slicer stages), else from
    the first row."""

    degree = Param(Params._dummy(), "degree", "polynomial degree",
                   typeConverter=TypeConverters.toInt)
    numFeatures = Param(Params._dummy(), "numFeatures", "input vector size",
                        typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="polyfeatures", degree=2, numFeatures=None):
        super().__init__()
        self._setDefault(degree=2)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _size(self, df: DataFrame) -> int:
        if self.isSet(self.numFeatures):
            return self.getOrDefault(self.numFeatures)
        from .stats import feature_size
        return feature_size(df, self.getInputCol())

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self._in()
        n = self._size(df)
        terms = []
        for t in poly_terms(n, self.getOrDefault(self.degree)):
            expr = None
            for j in range(n - 1, -1, -1):  # multiply the last variable first
                for _ in range(t[j]):
                    expr = F.get(v, j) if expr is None else expr * F.get(v, j)
            terms.append(expr)
        return with_vector(df, self.getOutputCol(), F.array(*terms), len(terms))


class ToMLVector(Transformer, _Stage):
    """``array<double>`` -> MLlib dense vector (for MLlib estimators)."""

    @keyword_only
    def __init__(self, inputCol="features", outputCol="features_vec"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), array_to_vector(self._in()))


class FromMLVector(Transformer, _Stage):
    """MLlib vector -> ``array<double>``."""

    @keyword_only
    def __init__(self, inputCol="features_vec", outputCol="features"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), vector_to_array(self._in()))


def unpack(df: DataFrame, col: str, size: int, prefix: str, start: int = 1,
           drop: bool = True) -> DataFrame:
    """Vector elements as scalar columns ``prefix{start}..``."""
    v = F.col(col)
    out = df.select("*", *[F.get(v, i).alias(f"{prefix}{i + start}") for i in range(size)])
    return out.drop(col) if drop else out


def song_stages(feature_indices: list[int], label_offset: float | None = None,
                value_col: str = "value") -> list:
    """The standard song featurisation: tokenize on ``,`` -> numbers ->
    label slice -> label double -> min shift -> feature slice."""
    return [
        Tokenizer(inputCol=value_col, outputCol="tokens", pattern=_regex_literal(",")),
        ArrayToVector(inputCol="tokens", outputCol="tokens_vector"),
        VectorSlicer(inputCol="tokens_vector", outputCol="year", indices=[0]),
        ElementToDouble(inputCol="year", outputCol="label", index=0),
        MinShift(inputCol="label", outputCol="label_shifted", offset=label_offset),
        VectorSlicer(inputCol="tokens_vector", outputCol="features", indices=feature_indices),
    ]
