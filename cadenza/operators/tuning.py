"""Grid search with k-fold cross-validation for models that fit on moments.

:func:`cross_validate` computes moments per fold in ONE grouped aggregate
(``groupBy(fold)``), then, for every (held-out fold, grid point), fits on
the other folds' combined moments and scores the held-out fold from its own
moments. The whole grid (e.g. 49 settings x 3 folds + refit) costs one
scan of the data instead of ~150 fits with several scans each.
:class:`CrossValidator` does so for a whole pipeline and gives a fitted one.

A model stage takes part in it if it has ``fit_moments`` and its models have
``linear_terms`` (elastic net and gradient descent do); :class:`CrossValidator`
also takes any other estimator, at the cost of a fit per fold and grid point.

Folds come from a row hash (:func:`cadenza.operators.split.with_fold`), so
they are reproducible. The metric is RMSE averaged over folds; lowest wins;
ties go to the earlier grid point (smaller maxIter, then smaller regParam).
"""

from __future__ import annotations

import itertools
import json
import math
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml import Pipeline as MLPipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metrics import RegressionEvaluator
from .linreg import mse_on
from .pipeline import Pipeline, fold
from .split import with_fold
from .stats import Moments, feature_size, moments, total


def param_grid(max_iter: list[int], reg_param: list[float]) -> list[dict]:
    """Cartesian grid, maxIter-major."""
    return [{"maxIter": m, "regParam": r} for m, r in itertools.product(max_iter, reg_param)]


#: Averages that agree to so many decimals are ties (settings that have converged alike).
TIE_DIGITS = 9


@dataclass
class CVResult:
    grid: list[dict]
    avg_metrics: list[float]
    fold_metrics: list[list[float]]
    best_index: int
    best_model: Model

    @property
    def best_params(self) -> dict:
        return self.grid[self.best_index]

    def metrics_frame(self, spark: SparkSession) -> DataFrame:
        """One row per grid point: its parameters (``maxIter`` as ``max_iter``) and ``avg_rmse``."""
        names = list(self.grid[0])
        whole = {n: all(isinstance(g[n], int) for g in self.grid) for n in names}
        schema = T.StructType(
            [T.StructField(_snake(n), T.IntegerType() if whole[n] else T.DoubleType(), False) for n in names]
            + [T.StructField("avg_rmse", T.DoubleType(), False)])
        rows = [(*((int if whole[n] else float)(g[n]) for n in names), float(m))
                for g, m in zip(self.grid, self.avg_metrics)]
        return spark.createDataFrame(rows, schema)


def _snake(name: str) -> str:
    return "".join("_" + c.lower() if c.isupper() else c for c in name)


def cross_validate(df: DataFrame, estimator: Estimator, grid: list[dict],
                   fold_col: str = "fold", eval_label_offset: float = 0.0) -> CVResult:
    """k-fold CV over ``grid`` from one grouped aggregate.

    ``eval_label_offset`` scores predictions against ``label + offset``
    (e.g. the unshifted year while the model learns the shifted one), for
    reproducing an evaluator that reads a different label column.
    """
    fc, lc = estimator.getFeaturesCol(), estimator.getLabelCol()
    d = feature_size(df, fc)
    per_fold = moments(df, fc, lc, d, by=fold_col)
    tested = [(*_held_out(per_fold, k), eval_label_offset) for k in _folds(per_fold)]
    return _search(estimator, grid, tested, total(per_fold))


def _folds(per_fold: dict) -> list:
    if len(per_fold) < 2:
        raise ValueError("cross-validation needs at least two non-empty folds")
    return sorted(per_fold)


def _held_out(per_fold: dict, k) -> tuple[Moments, Moments]:
    """(moments of the other folds, moments of fold k)."""
    return total({f: m for f, m in per_fold.items() if f != k}), per_fold[k]


def _search(estimator: Estimator, grid: list[dict], tested: list[tuple[Moments, Moments, float]], whole: Moments) -> CVResult:
    """Every grid point fitted and scored per fold from (train, test, label offset of
    the score), and the best one fitted on ``whole``."""
    fold_metrics = []
    for train, test, offset in tested:
        row = []
        for g in grid:
            model = estimator.copy(_to_params(estimator, g)).fit_moments(train)
            row.append(math.sqrt(mse_on(test, *model.linear_terms(), offset)))
        fold_metrics.append(row)
    best, avg = _best(grid, fold_metrics)
    return CVResult(grid, avg, fold_metrics, best, estimator.copy(_to_params(estimator, grid[best])).fit_moments(whole))


def _best(grid: list[dict], fold_metrics: list[list[float]]) -> tuple[int, list[float]]:
    avg = [sum(col) / len(col) for col in zip(*fold_metrics)]
    return min(range(len(grid)), key=lambda i: (round(avg[i], TIE_DIGITS), i)), avg


def _to_params(est: Estimator, g: dict) -> dict:
    return {est.getParam(k): v for k, v in g.items()}


class CrossValidator(Estimator):
    """Cross-validation of a whole pipeline, nothing learned on held-out rows.

    Folds are row hashes of ``key_cols``. For each held-out fold every stage and the
    model are those of the other folds. Where the pipeline folds into moments
    (:mod:`.pipeline`), ONE grouped pass gives the moments and the minima per fold;
    the minimum without a fold is that of the others' minima. Else the stages are
    fitted once per fold; a model that does not fit on moments is also fitted once
    per fold and grid point, on cached rows.

    ``label_col`` (default: the model's label column) is scored, which must differ
    from the model's label by a constant per fold only, as a shifted label does.
    ``fit`` returns a :class:`CrossValidatedModel`, whose ``transform`` runs the
    stages and the best model fitted on all the rows given.
    """

    def __init__(self, pipeline: MLPipeline, grid: list[dict], key_cols: list[str], folds: int = 3,
                 label_col: str | None = None):
        super().__init__()
        if not (isinstance(last := pipeline.getStages()[-1], Estimator) and hasattr(last, "getLabelCol")):
            raise TypeError("the last stage must be a model's estimator")
        self.pipeline, self.grid, self.key_cols = pipeline, grid, key_cols
        self.folds, self.label_col = folds, label_col

    def _fit(self, df: DataFrame) -> CrossValidatedModel:
        *stages, estimator = self.pipeline.getStages()
        rows = with_fold(df, self.key_cols, self.folds, col=FOLD)
        on_moments = hasattr(estimator, "fit_moments") and estimator.fitsOnMoments()
        folded = fold(stages, estimator, rows) if on_moments else None
        if folded is not None and FOLD in folded.rows.columns:
            return self._from_one_pass(folded, estimator)
        return self._fold_by_fold(stages, estimator, rows, on_moments)

    def _scored(self, estimator) -> str | None:
        """The column to score where it is another than the model's label."""
        return None if self.label_col in (None, estimator.getLabelCol()) else self.label_col

    def _from_one_pass(self, folded, estimator) -> CrossValidatedModel:
        fc, scored, low = estimator.getFeaturesCol(), self._scored(estimator), list(folded.low)
        if scored:
            # the gap to the unshifted label must be one constant: its least and its negated greatest
            gap = F.col(scored) - F.col(folded.label)
            low += [gap, -gap]
        per_fold = moments(folded.rows, fc, folded.label, feature_size(folded.rows, fc), by=FOLD, mins=low)
        whole = total(per_fold)
        gap = _constant(whole.mins[-2], whole.mins[-1], scored, estimator) if scored else 0.0
        tested, learned = [], []
        for k in _folds(per_fold):
            train, test = _held_out(per_fold, k)
            shift = 0.0 if folded.label_shift is None else train.mins[folded.label_shift]
            # an unshifted column is the shifted label plus the shift and the gap
            tested.append((folded.shifted(train, train.mins), folded.shifted(test, train.mins), gap + shift if scored else 0.0))
            learned.append(folded.learned(train.mins))
        result = _search(estimator, self.grid, tested, folded.shifted(whole, whole.mins))
        return CrossValidatedModel(PipelineModel(stages=[*folded.learned(whole.mins), result.best_model]), result, learned)

    def _fold_by_fold(self, stages, estimator, rows, on_moments: bool) -> CrossValidatedModel:
        scored = self._scored(estimator)
        found = sorted(r[FOLD] for r in rows.groupBy(FOLD).count().limit(self.folds).collect())
        _folds(dict.fromkeys(found))
        fold_metrics, learned = [], []
        for k in found:
            fitted = MLPipeline(stages=stages).fit(rows.where(F.col(FOLD) != k))
            learned.append(fitted.stages)
            done = fitted.transform(rows)
            if on_moments:
                fc, lc = estimator.getFeaturesCol(), estimator.getLabelCol()
                low = [F.col(scored) - F.col(lc), F.col(lc) - F.col(scored)] if scored else []
                per_fold = moments(done, fc, lc, feature_size(done, fc), by=FOLD, mins=low)
                train, test = _held_out(per_fold, k)
                both = total(per_fold).mins
                gap = _constant(*both, scored, estimator) if scored else 0.0
                fold_metrics.append(_search(estimator, self.grid, [(train, test, gap)], train).fold_metrics[0])
                continue
            done = done.persist()
            try:
                train, test = done.where(F.col(FOLD) != k), done.where(F.col(FOLD) == k)
                evaluator = RegressionEvaluator(labelCol=scored or estimator.getLabelCol(), predictionCol=estimator.getPredictionCol())
                fold_metrics.append([evaluator.evaluate(estimator.copy(_to_params(estimator, g)).fit(train).transform(test))
                                     for g in self.grid])
            finally:
                done.unpersist()
        best, avg = _best(self.grid, fold_metrics)
        chosen = estimator.copy(_to_params(estimator, self.grid[best]))
        model = Pipeline(stages=[*stages, chosen]).fit(rows.drop(FOLD))
        result = CVResult(self.grid, avg, fold_metrics, best, model.stages[-1])
        return CrossValidatedModel(model, result, learned)


def _constant(low: float | None, negated_high: float | None, scored: str, estimator) -> float:
    if low is None or abs(-negated_high - low) > 1e-9 * max(1.0, abs(low)):
        raise ValueError(f"{scored} is not {estimator.getLabelCol()} plus a constant")
    return float(low)


class CrossValidatedModel(Model):
    """``best`` is the pipeline fitted on all rows, ``result`` the search, and
    ``fold_stages`` the stages learned without each fold. Saved as a pipeline and
    a table of the grid."""

    def __init__(self, best: PipelineModel, result: CVResult, fold_stages: list | None = None):
        super().__init__()
        self.best, self.result, self.fold_stages = best, result, fold_stages or []

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.best.transform(df)

    def save(self, path: str) -> None:
        """Write the best pipeline and the search; an existing folder is an error."""
        spark = SparkSession.getActiveSession()
        self.best.write().save(f"{path}/best")
        rows = [(i, json.dumps(g), float(m), [float(f[i]) for f in self.result.fold_metrics], i == self.result.best_index)
                for i, (g, m) in enumerate(zip(self.result.grid, self.result.avg_metrics))]
        spark.createDataFrame(rows, "i int, params string, avg double, folds array<double>, best boolean").coalesce(1).write.json(f"{path}/grid")

    @classmethod
    def load(cls, path: str) -> CrossValidatedModel:
        spark = SparkSession.getActiveSession()
        best = PipelineModel.load(f"{path}/best")
        rows = spark.read.schema("i int, params string, avg double, folds array<double>, best boolean").json(f"{path}/grid")
        rows = rows.orderBy("i").limit(MAX_GRID).collect()
        folds = [list(f) for f in zip(*(r["folds"] for r in rows))]
        result = CVResult([json.loads(r["params"]) for r in rows], [r["avg"] for r in rows], folds,
                          next(r["i"] for r in rows if r["best"]), best.stages[-1])
        return cls(best, result)


#: Grid points of a saved search at most.
MAX_GRID = 100_000
FOLD = "_cv_fold"


def mllib_cross_validate(df: DataFrame, features: str, label: str, grid: list[dict],
                         fold_col: str = "fold", alpha: float = 0.1, parallelism: int = 4):
    """The same search with MLlib's ``CrossValidator`` (one fit per fold and
    grid point), for comparison. Returns the fitted ``CrossValidatorModel``;
    its ``avgMetrics`` follow the order of ``grid``."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import CrossValidator as MLlibCrossValidator

    data = df.select(array_to_vector(features).alias("_fv"), F.col(label).alias("_y"),
                     F.col(fold_col).cast("int").alias(fold_col))
    lr = LinearRegression(featuresCol="_fv", labelCol="_y", elasticNetParam=alpha)
    maps = [{lr.maxIter: int(g["maxIter"]), lr.regParam: float(g["regParam"])} for g in grid]
    ev = RegressionEvaluator(metricName="rmse", labelCol="_y", predictionCol="prediction")
    cv = MLlibCrossValidator(estimator=lr, estimatorParamMaps=maps, evaluator=ev,
                        foldCol=fold_col, parallelism=parallelism)
    return cv.fit(data)
