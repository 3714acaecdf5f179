"""Elastic-net linear regression with intercept and standardisation.

Objective (the one MLlib's ``LinearRegression`` minimises with
``standardization=True``): on features scaled by their population
deviation and the label scaled by its deviation,
``1/(2n) sum (y - w0 - w.x)^2 + lambda (a |w|_1 + (1-a)/2 |w|^2)`` with
``lambda = regParam / sigma_y``.

:class:`ElasticNet` solves it exactly, by coordinate descent and active-set steps
on the correlation matrix from ONE aggregate pass (:mod:`.stats`), so fitting,
scoring metrics and cross-validation never rescan the data per iteration.
:func:`mllib_fit` runs MLlib's own estimator for comparison.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasElasticNetParam, HasFeaturesCol, HasLabelCol,
                                     HasMaxIter, HasPredictionCol, HasRegParam, HasTol)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metrics import error_aggs
from ..functions.vectors import dot_const
from .stats import Moments, feature_size, moments


@dataclass
class Solution:
    """``rounds`` were made; ``converged`` says whether the optimality conditions
    hold to the tolerance at the end."""

    coef: np.ndarray
    intercept: float
    rounds: int
    converged: bool


#: Optimality conditions of a standardised problem count as met within this.
KKT_TOL = 1e-12


def violation(R: np.ndarray, r: np.ndarray, l1: float, l2: float, w: np.ndarray) -> float:
    """By how much ``w`` misses the optimality conditions of
    ``w.R.w / 2 - r.w + l1 |w|_1 + l2 |w|^2 / 2``."""
    if not len(w):
        return 0.0
    g = R @ w - r + l2 * w
    return float(np.where(w != 0, np.abs(g + l1 * np.sign(w)), np.maximum(np.abs(g) - l1, 0.0)).max())


def _sweep(R: np.ndarray, r: np.ndarray, l1: float, l2: float, w: np.ndarray) -> np.ndarray:
    """One round of coordinate descent with covariance updates."""
    w, g = w.copy(), R @ w
    for j in range(len(w)):
        z = r[j] - g[j] + R[j, j] * w[j]
        new = np.sign(z) * max(abs(z) - l1, 0.0) / (R[j, j] + l2)
        if new != w[j]:
            g += R[:, j] * (new - w[j])
            w[j] = new
    return w


def _active_step(R: np.ndarray, r: np.ndarray, l1: float, l2: float, w: np.ndarray) -> np.ndarray:
    """The minimum over the coefficients that are not zero, signs held; where a
    sign would change, the best point on the way there."""
    on = np.flatnonzero(w)
    if not len(on):
        return w
    A, sign = R[np.ix_(on, on)] + l2 * np.eye(len(on)), np.sign(w[on])
    target = np.linalg.lstsq(A, r[on] - l1 * sign, rcond=None)[0]
    step = target - w[on]
    with np.errstate(divide="ignore", invalid="ignore"):
        crossing = -w[on] / step
    stops = np.append(np.sort(crossing[(crossing > 0) & (crossing < 1)]), 1.0)
    best, least = w, np.inf
    for t in stops:
        x = np.zeros_like(w)
        x[on] = w[on] + t * step
        x[on[np.abs(crossing - t) < 1e-15]] = 0.0
        value = 0.5 * x @ R @ x - r @ x + l1 * np.abs(x).sum() + 0.5 * l2 * x @ x
        if value < least:
            best, least = x, value
    return best


def settle(R: np.ndarray, r: np.ndarray, l1: float, l2: float, w: np.ndarray, tol: float,
           max_rounds: int) -> tuple[np.ndarray, int, bool]:
    """(coefficients, rounds, converged) of the standardised problem, from ``w`` on."""
    rounds, converged = 0, violation(R, r, l1, l2, w) <= tol
    while rounds < max_rounds and not converged:
        rounds += 1
        w = _active_step(R, r, l1, l2, _sweep(R, r, l1, l2, w))
        converged = violation(R, r, l1, l2, w) <= tol
    return w, rounds, bool(converged)


def solve(m: Moments, reg: float, alpha: float, tol: float = KKT_TOL, max_rounds: int = 1000) -> Solution:
    """The elastic net on moments, at most ``max_rounds`` rounds. A round is a sweep
    of coordinate descent, which finds the coefficients that are not zero, and an
    exact step over those (their number of rounds does not grow with collinearity)."""
    d = m.d
    var = np.diag(m.cov)
    sx = np.sqrt(np.maximum(var[:d], 0.0))
    sy = float(np.sqrt(max(var[d], 0.0)))
    coef = np.zeros(d)
    if sy == 0.0:
        return Solution(coef, float(m.mean[d]), 0, True)
    live = sx > 0
    idx = np.flatnonzero(live)
    R = m.cov[np.ix_(idx, idx)] / np.outer(sx[idx], sx[idx])
    r = m.cov[idx, d] / (sx[idx] * sy)
    lam = reg / sy
    l1, l2 = lam * alpha, lam * (1.0 - alpha)
    if l1 == 0.0:
        # no L1 term: the ridge normal equations have a closed form
        A = R + l2 * np.eye(len(idx))
        w = np.linalg.lstsq(A, r, rcond=None)[0]
        coef[idx] = w * sy / sx[idx]
        return Solution(coef, float(m.mean[d] - coef @ m.mean[:d]), 0, True)
    w, rounds, converged = settle(R, r, l1, l2, np.zeros(len(idx)), max(tol, KKT_TOL), max_rounds)
    coef[idx] = w * sy / sx[idx]
    coef[coef == 0.0] = 0.0  # no signed zeros from the soft threshold
    return Solution(coef, float(m.mean[d] - coef @ m.mean[:d]), rounds, converged)


def mse_on(m: Moments, coef: np.ndarray, intercept: float, label_offset: float = 0.0) -> float:
    """Mean squared error of ``intercept + coef.x`` against ``y + label_offset``
    on rows summarised by ``m`` (no pass over the rows)."""
    d = m.d
    mean_e = m.mean[d] + label_offset - intercept - coef @ m.mean[:d]
    var_e = m.cov[d, d] - 2.0 * coef @ m.cov[:d, d] + coef @ m.cov[:d, :d] @ coef
    return float(max(var_e, 0.0) + mean_e * mean_e)


class _ENParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRegParam,
                HasElasticNetParam, HasMaxIter, HasTol):
    solver = Param(Params._dummy(), "solver", "'moments' (one pass, d x d numbers) or 'span' (passes with d x k numbers)",
                   typeConverter=TypeConverters.toString)
    stateKey = Param(Params._dummy(), "stateKey", "name of the state that solver 'span' keeps in the shared folder after "
                     "every pass; a fit of the same rows with the same key goes on from there", typeConverter=TypeConverters.toString)


class ElasticNet(Estimator, _ENParams, DefaultParamsReadable, DefaultParamsWritable):
    """Elastic net on ``array<double>`` features: at most ``maxIter`` rounds of
    :func:`solve`, fewer when it converges (``tol``). The model records both; a
    fit that has not converged warns. For vectors too wide for a d x d matrix on the
    driver, ``solver="span"`` makes at most ``maxIter`` passes (:mod:`.wide`), with a
    ``tol`` of at least 1e-9."""

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction",
                 regParam=0.0, elasticNetParam=0.0, maxIter=100, tol=KKT_TOL, solver="moments", stateKey=None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction",
                         regParam=0.0, elasticNetParam=0.0, maxIter=100, tol=KKT_TOL, solver="moments")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def fitsOnMoments(self) -> bool:
        return self.getOrDefault(self.solver) == "moments"

    def fit_moments(self, m: Moments) -> "LinearModel":
        return self._model(solve(m, self.getRegParam(), self.getElasticNetParam(), self.getTol(), self.getMaxIter()))

    def _model(self, found: Solution) -> "LinearModel":
        if not found.converged:
            warnings.warn(f"elastic net has not converged in maxIter={self.getMaxIter()} rounds", stacklevel=2)
        model = LinearModel(coefficients=[float(c) for c in found.coef], intercept=found.intercept,
                            rounds=found.rounds, converged=found.converged)
        return self._copyValues(model)

    def _fit(self, df: DataFrame) -> "LinearModel":
        fc, lc = self.getFeaturesCol(), self.getLabelCol()
        d = feature_size(df, fc)
        if self.fitsOnMoments():
            return self.fit_moments(moments(df, fc, lc, d)[None])
        from .wide import elastic_net_by_columns, ridge_in_span
        key = self.getOrDefault(self.stateKey) if self.isSet(self.stateKey) else None
        reg, alpha, tol = self.getRegParam(), self.getElasticNetParam(), max(self.getTol(), 1e-9)
        if reg * alpha == 0.0:
            return self._model(Solution(*ridge_in_span(df, fc, lc, d, reg, self.getMaxIter(), tol, state_key=key)))
        return self._model(Solution(*elastic_net_by_columns(df, fc, lc, d, reg, alpha, self.getMaxIter(), tol, state_key=key)))


class LinearModel(Model, _ENParams, DefaultParamsReadable, DefaultParamsWritable):
    coefficients = Param(Params._dummy(), "coefficients", "coefficients",
                         typeConverter=TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept",
                      typeConverter=TypeConverters.toFloat)

    rounds = Param(Params._dummy(), "rounds", "rounds made",
                   typeConverter=TypeConverters.toInt)
    converged = Param(Params._dummy(), "converged", "whether they converged",
                      typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, coefficients=None, intercept=0.0, rounds=None, converged=None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction",
                         intercept=0.0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def getCoefficients(self) -> list[float]:
        return self.getOrDefault(self.coefficients)

    def linear_terms(self) -> tuple[np.ndarray, float]:
        """(coefficients, intercept)."""
        return np.array(self.getCoefficients(), dtype=float), self.getIntercept()

    def getRounds(self) -> int:
        return self.getOrDefault(self.rounds)

    def hasConverged(self) -> bool:
        return self.getOrDefault(self.converged)

    def getIntercept(self) -> float:
        return self.getOrDefault(self.intercept)

    def prediction(self):
        return F.lit(self.getIntercept()) + dot_const(self.getFeaturesCol(), self.getCoefficients())

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getPredictionCol(), self.prediction())

    def evaluate(self, df: DataFrame, label: str | None = None) -> DataFrame:
        """``rmse, mse, mae, n`` of this model on ``df`` in one aggregate."""
        return df.agg(*error_aggs(label or self.getLabelCol(), self.prediction()))

    def terms_frame(self, spark: SparkSession) -> DataFrame:
        """``term string, value double``: intercept then x1..xd."""
        rows = [("intercept", self.getIntercept())]
        rows += [(f"x{i + 1}", c) for i, c in enumerate(self.getCoefficients())]
        schema = T.StructType([T.StructField("term", T.StringType(), False),
                               T.StructField("value", T.DoubleType(), False)])
        return spark.createDataFrame(rows, schema)


def mllib_fit(df: DataFrame, features: str, label: str, reg: float, alpha: float,
              max_iter: int = 100):
    """MLlib's ``LinearRegression`` on the same array features (converted to
    MLlib vectors at the edge). Returns (coefficients, intercept, model)."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression

    data = df.select(array_to_vector(features).alias("_fv"), F.col(label).alias("_y"))
    lr = LinearRegression(featuresCol="_fv", labelCol="_y", regParam=reg,
                          elasticNetParam=alpha, maxIter=max_iter)
    model = lr.fit(data)
    return np.array(model.coefficients.toArray()), float(model.intercept), model
