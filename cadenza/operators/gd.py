"""Batch gradient-descent linear regression (no intercept) as an ML stage.

Model: ``prediction = w . x``. Starting from ``w = 0``, iteration ``i``
(0-based) records the training RMSE of the current ``w`` and then steps
``w -= stepSize / (n * sqrt(i + 1)) * sum_rows((w . x - y) x)``.

The gradient is linear in ``w``: ``sum((w.x - y) x) = G w - b`` with
``G = X^T X`` and ``b = X^T y``, and ``RMSE(w)^2 = (w^T G w - 2 w^T b + y^T y)/n``.
So ``mode="gram"`` (default) makes ONE distributed aggregate pass for
``n, G, b, y^T y`` and runs the iterations on d x d numbers; the weights and
history equal the per-row loop's up to rounding. For vectors too wide for a
d x d matrix on the driver, ``mode="span"`` makes passes that are worth many steps
each (:mod:`.wide`), with a bound on the error; ``mode="iterative"`` makes one pass
per iteration over the (persisted) input, a NumPy partial per partition.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import dot_const
from .stats import Moments, check_rows, feature_size, moments


class _GDParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter):
    stepSize = Param(Params._dummy(), "stepSize", "base step (alpha)",
                     typeConverter=TypeConverters.toFloat)
    mode = Param(Params._dummy(), "mode", "'gram' (one pass), 'span' (a pass for many steps) or 'iterative' (one pass per step)",
                 typeConverter=TypeConverters.toString)
    stateKey = Param(Params._dummy(), "stateKey", "name of the state that mode 'span' keeps in the shared folder after "
                     "every pass; a fit of the same rows with the same key goes on from there", typeConverter=TypeConverters.toString)


def rmse_at(G: np.ndarray, b: np.ndarray, yy: float, n: float, w: np.ndarray) -> float:
    """Training RMSE of weights ``w`` from the statistics."""
    sse = float(w @ G @ w - 2.0 * w @ b + yy)
    return math.sqrt(max(sse, 0.0) / n)


def descend(G: np.ndarray, b: np.ndarray, yy: float, n: float, iters: int,
            step: float) -> tuple[np.ndarray, list[float]]:
    """The iteration on sufficient statistics. Returns final weights and the
    RMSE recorded before each update."""
    w = np.zeros(len(b))
    hist = []
    for i in range(iters):
        with np.errstate(over="ignore", invalid="ignore"):
            sse = float(w @ G @ w - 2.0 * w @ b + yy)
            hist.append(math.sqrt(max(sse, 0.0) / n))
            w = w - (step / (n * math.sqrt(i + 1))) * (G @ w - b)
        if not np.all(np.isfinite(w)):
            raise FloatingPointError(
                f"gradient descent diverged at iteration {i}; scale the features "
                "or lower stepSize")
    return w, hist


class GradientDescentRegression(Estimator, _GDParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction",
                 maxIter=100, stepSize=1.0, mode="gram", stateKey=None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction",
                         maxIter=100, stepSize=1.0, mode="gram")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def fitsOnMoments(self) -> bool:
        return self.getOrDefault(self.mode) == "gram"

    def fit_moments(self, m: Moments) -> "GradientDescentModel":
        G, b, yy = m.gram()
        w, hist = descend(G, b, yy, m.n, self.getMaxIter(), self.getOrDefault(self.stepSize))
        return self._model(w, hist, rmse_at(G, b, yy, m.n, w))

    def _model(self, w, hist, final) -> "GradientDescentModel":
        model = GradientDescentModel(weights=[float(x) for x in w], trainingError=[float(x) for x in hist],
                                     finalError=float(final))
        return self._copyValues(model)

    def _fit(self, df: DataFrame) -> "GradientDescentModel":
        fc, lc = self.getFeaturesCol(), self.getLabelCol()
        iters, step = self.getMaxIter(), self.getOrDefault(self.stepSize)
        data = df.select(fc, F.col(lc).cast("double").alias(lc))
        d = feature_size(data, fc)
        if self.getOrDefault(self.mode) == "gram":
            return self.fit_moments(moments(data, fc, lc, d)[None])
        if self.getOrDefault(self.mode) == "span":
            from .wide import descend_in_span
            key = self.getOrDefault(self.stateKey) if self.isSet(self.stateKey) else None
            w, hist, final, _ = descend_in_span(data, fc, lc, d, iters, step, state_key=key)
            return self._model(w, hist, final)
        return self._model(*self._fit_iterative(data, fc, lc, d, iters, step))

    @staticmethod
    def _fit_iterative(data, fc, lc, d, iters, step):
        data = data.persist()
        try:
            n, _, _ = gradient(data, fc, lc, np.zeros(d))
            if n == 0:
                raise ValueError("empty training set: no rows to learn from")
            w = np.zeros(d)
            hist = []
            for i in range(iters):
                _, sse, g = gradient(data, fc, lc, w)
                hist.append(math.sqrt(sse / n))
                w = w - (step / (n * math.sqrt(i + 1))) * g
                if not np.all(np.isfinite(w)):
                    raise FloatingPointError(f"gradient descent diverged at iteration {i}; scale the "
                                             "features or lower stepSize")
            _, sse, _ = gradient(data, fc, lc, w)
            return w, hist, math.sqrt(sse / n)
        finally:
            data.unpersist()


def gradient(data: DataFrame, features: str, label: str, w: np.ndarray) -> tuple[int, float, np.ndarray]:
    """(rows, squared error, gradient) of ``sum((w . x - y)^2) / 2`` in one pass.

    Each partition makes one NumPy partial over its Arrow batches and emits it
    as d + 4 cells, which Spark sums by cell; d numbers reach the driver. The
    rows are validated like those of :func:`cadenza.operators.stats.moments`.
    """
    d = len(w)

    def partial(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        out = np.zeros(d + 4)  # gradient, squared error, rows, rows of another size, bad rows
        for batch in batches:
            sizes = pc.list_value_length(batch.column("x")).to_numpy(zero_copy_only=False)
            whole = sizes == d
            missing = int(np.isnan(np.asarray(sizes, dtype=float)).sum())
            out[d + 2] += (~whole).sum() - missing
            batch = batch.filter(pa.array(whole))
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
            finite = np.isfinite(x).all(axis=1) & np.isfinite(y)
            out[d + 3] += missing + (~finite).sum()
            x, y = x[finite], y[finite]
            with np.errstate(over="ignore", invalid="ignore"):
                r = x @ w - y
                out[:d] += r @ x
                out[d] += r @ r
            out[d + 1] += len(y)
        yield pa.RecordBatch.from_pydict({"i": np.arange(d + 4), "v": out})

    cells = (data.select(F.col(features).alias("x"), F.col(label).cast("double").alias("y"))
             .mapInArrow(partial, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect())
    total = np.zeros(d + 4)
    for r in cells:
        total[r["i"]] = r["v"]
    check_rows(d, total[d + 2], total[d + 3])
    return int(total[d + 1]), float(total[d]), total[:d]


class GradientDescentModel(Model, _GDParams, DefaultParamsReadable, DefaultParamsWritable):
    weights = Param(Params._dummy(), "weights", "learned weights",
                    typeConverter=TypeConverters.toListFloat)
    trainingError = Param(Params._dummy(), "trainingError",
                          "training RMSE before each update",
                          typeConverter=TypeConverters.toListFloat)
    finalError = Param(Params._dummy(), "finalError", "training RMSE of the returned weights",
                       typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, weights=None, trainingError=None, finalError=None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def getWeights(self) -> list[float]:
        return self.getOrDefault(self.weights)

    def linear_terms(self) -> tuple[np.ndarray, float]:
        """(weights, intercept): the model has no intercept."""
        return np.array(self.getWeights(), dtype=float), 0.0

    def getTrainingError(self) -> list[float]:
        """RMSE before update i; the last entry is the error before the final
        update, not of the returned weights (see :meth:`getFinalError`)."""
        return self.getOrDefault(self.trainingError)

    def getFinalError(self) -> float:
        return self.getOrDefault(self.finalError)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getPredictionCol(),
                             dot_const(self.getFeaturesCol(), self.getWeights()))

    def history(self, spark: SparkSession) -> DataFrame:
        """``iteration int, rmse double``: RMSE before update ``iteration``."""
        schema = T.StructType([T.StructField("iteration", T.IntegerType(), False),
                               T.StructField("rmse", T.DoubleType(), False)])
        return spark.createDataFrame(list(enumerate(self.getTrainingError())), schema)

    def weights_frame(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([T.StructField("i", T.IntegerType(), False),
                               T.StructField("weight", T.DoubleType(), False)])
        return spark.createDataFrame(list(enumerate(self.getWeights())), schema)
