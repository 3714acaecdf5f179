"""Registered queries for vectors, features, splits and models.

Model queries follow one recipe: song lines -> hash split 80/20 on
``song_id`` -> feature pipeline fitted on the training rows (the label
minimum is learned there) -> model. Order-dependent floating results are
rounded to ``R`` decimals.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from ..functions import vectors as V
from ..functions.metrics import error_aggs
from ..operators import features as fe
from ..operators import split as sp
from ..operators.gd import GradientDescentRegression
from ..operators.linreg import ElasticNet
from ..operators.aggregate import Aggregator, aggregate, reduce_by
from ..operators.pipeline import Pipeline, fold
from ..operators.stats import moments, total
from ..operators.tuning import CrossValidator, param_grid
from .queries import R, query

KEY = ["song_id"]
FEATURES_3 = [1, 2, 3]
# Fixed values of the modelling workloads.
ALPHA = 0.1                 # elastic-net mixing
REG = 0.9                   # chosen regParam
MAX_ITER = 50               # chosen maxIter
GRID_MAX_ITER = [20, 30, 40, 50, 60, 70, 80]
GRID_REG = [0.4, 0.6, 0.8, 0.9, 1.0, 1.2, 1.4]
FOLDS = 3
GD_ITERS = 100
GD_STEP = 1.0
GD_GRID_ITERS, GD_GRID_STEP = [20, 50, 100], [0.1, 0.5, 1.0]
GD_PROBE_W = [1.0, 1.0, 1.0]  # weights at which gd_gradient is evaluated


def _round(c, name):
    return F.round(c, R).alias(name)


def _featurized(spark: SparkSession, sf: str, indices=FEATURES_3) -> DataFrame:
    lines = fx.song_lines(spark, sf)
    return Pipeline(stages=fe.song_stages(indices)).fit(lines).transform(lines)


def _unshifted(spark: SparkSession, sf: str, indices=FEATURES_3) -> DataFrame:
    """The song features without the label shift: nothing to learn, so no job."""
    stages = [s for s in fe.song_stages(indices) if not isinstance(s, fe.MinShift)]
    return PipelineModel(stages=stages).transform(fx.song_lines(spark, sf))


def _train_test(spark: SparkSession, sf: str, indices=FEATURES_3, poly: bool = False):
    lines = fx.song_lines(spark, sf)
    train_l, test_l = sp.hash_split(lines, KEY, [0.8, 0.2])
    stages = fe.song_stages(indices)
    if poly:
        stages.append(fe.PolyExpansion(inputCol="features", outputCol="polyfeatures",
                                       degree=2, numFeatures=len(indices)))
    pm: PipelineModel = Pipeline(stages=stages).fit(train_l)
    return pm.transform(train_l), pm.transform(test_l)


# --- feature stages -----------------------------------------------------------

@query("tokenize")
def q_tokenize(spark, sf):
    t = fe.Tokenizer(inputCol="value", outputCol="tokens", pattern=",").transform(
        fx.song_lines(spark, sf))
    return t.select("song_id", F.size("tokens").alias("n_tokens"),
                    F.get("tokens", 0).cast("double").alias("label"))


@query("tokens_to_features")
def q_tokens_to_features(spark, sf):
    lines = fx.song_lines(spark, sf)
    pm = PipelineModel(stages=[fe.Tokenizer(inputCol="value", outputCol="tokens", pattern=","),
                               fe.ArrayToVector(inputCol="tokens", outputCol="tokens_vector")])
    out = pm.transform(lines).select("song_id", "tokens_vector")
    return fe.unpack(out, "tokens_vector", 13, "v", start=0)


@query("label_slice")
def q_label_slice(spark, sf):
    return _unshifted(spark, sf).select("song_id", "label")


@query("label_shift")
def q_label_shift(spark, sf):
    return _featurized(spark, sf).select("song_id", "label", "label_shifted")


@query("feature_frame")
def q_feature_frame(spark, sf):
    out = _featurized(spark, sf).drop("value", "tokens", "tokens_vector", "year")
    return fe.unpack(out, "features", 3, "x")


@query("poly_features")
def q_poly_features(spark, sf):
    out = fe.PolyExpansion(inputCol="features", outputCol="poly", degree=2,
                           numFeatures=3).transform(_unshifted(spark, sf))
    # element products are single IEEE operations: exact, no rounding needed
    return out.select("song_id", *[F.get("poly", i).alias(f"p{i + 1}") for i in range(9)])


@query("min_label")
def q_min_label(spark, sf):
    return _unshifted(spark, sf).agg(F.min("label").alias("min_label"))


@query("top_row")
def q_top_row(spark, sf):
    top = _unshifted(spark, sf).orderBy("label", "tokens_vector").limit(1)
    return fe.unpack(top.select("label", "tokens_vector"), "tokens_vector", 13, "v", start=0)


@query("column_fn_stage")
def q_column_fn_stage(spark, sf):
    """A user function of a column as a stage: the decade of the label."""
    stage = fe.ColumnFn(lambda c: F.floor(c / 10) * 10, "label", "decade")
    return stage.transform(_unshifted(spark, sf)).select("song_id", "decade")


@query("vector_fn_stage")
def q_vector_fn_stage(spark, sf):
    """A user function of whole vectors (a NumPy matrix per batch) as a stage."""
    stage = fe.PandasArrayFn(lambda m: m[:, 0] * 2.0 - m[:, 2], "features", "y")
    return stage.transform(_unshifted(spark, sf)).select("song_id", "y")


def high_fields(line):
    """The numbered fields of a song line that are over 0.9, the year left out."""
    for i, v in enumerate(line.split(",")[1:], 1):
        if float(v) > 0.9:
            yield {"field": i, "level": float(v)}


@query("one_to_many_stage")
def q_one_to_many_stage(spark, sf):
    """A user function from one row to any number of rows as a pipeline stage."""
    stage = fe.FlatMapFn(high_fields, "value", "high", "struct<field: int, level: double>", positionCol="nth", outer=True)
    out = stage.transform(fx.song_lines(spark, sf))
    return out.select("song_id", "nth", "high.field", "high.level")


# --- vector expressions ---------------------------------------------------------

def _pairs(spark, sf):
    df = _unshifted(spark, sf)
    return df.select("song_id", "features",
                     V.slice_indices("tokens_vector", [4, 5, 6]).alias("other"))


@query("vector_dot")
def q_vector_dot(spark, sf):
    return _pairs(spark, sf).select("song_id", V.dot("features", "other").alias("dot"))


@query("vector_scale")
def q_vector_scale(spark, sf):
    out = _pairs(spark, sf).select("song_id", V.scale("features", 2.5).alias("v"))
    return out.select("song_id", *[F.get("v", i).alias(f"s{i + 1}") for i in range(3)])


@query("vector_add")
def q_vector_add(spark, sf):
    out = _pairs(spark, sf).select("song_id", V.add("features", "other").alias("v"))
    return out.select("song_id", *[F.get("v", i).alias(f"a{i + 1}") for i in range(3)])


@query("vector_fill")
def q_vector_fill(spark, sf):
    out = _featurized(spark, sf).select("song_id", V.fill(3, "label_shifted").alias("z"))
    return fe.unpack(out, "z", 3, "z")


@query("vector_sum")
def q_vector_sum(spark, sf):
    sums = _unshifted(spark, sf).agg(*V.sum_agg("features", 3))
    return sums.select(*[_round(F.col(f"s{i}"), f"s{i + 1}") for i in range(3)])


@query("rmse_metric")
def q_rmse_metric(spark, sf):
    df = _featurized(spark, sf).withColumn(
        "prediction", V.dot_const("features", [40.0, 25.0, 15.0]))
    m = df.agg(*error_aggs("label_shifted", "prediction"))
    return m.select(*[_round(F.col(c), c) for c in ("rmse", "mse", "mae")])


# --- user aggregates -------------------------------------------------------------

def _era():
    """A key that most songs share: the decade of the label, all but each fourth in one."""
    decade = F.floor(F.col("label") / 10).cast("int")
    return F.when(decade % 4 == 0, decade * 10).otherwise(-1).alias("era")


@query("user_reduce")
def q_user_reduce(spark, sf):
    """A user function of two vectors folded over each key: their elementwise maximum."""
    rows = _unshifted(spark, sf).select(_era(), "features")
    top = reduce_by(rows, "features", lambda a, b: [max(x, y) for x, y in zip(a, b)], ["era"])
    return fe.unpack(top, "value", 3, "top")


class Spread(Aggregator):
    """Count, mean and variance of one column and a histogram of another in tenths."""

    schema = "n long, mean double, variance double, tenths array<long>"
    state_bytes = 1024

    def zero(self):
        return 0, 0.0, 0.0, np.zeros(11, np.int64)

    def update(self, state, rows):
        x, y = (rows.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        mean = x.mean()
        tenths = np.bincount(np.floor(y * 10).astype(np.int64), minlength=11)
        return self.merge(state, (len(x), mean, ((x - mean) ** 2).sum(), tenths))

    def merge(self, a, b):
        n, gap = a[0] + b[0], b[1] - a[1]
        if not a[0] or not b[0]:
            return b if b[0] else a
        return n, a[1] + gap * b[0] / n, a[2] + b[2] + gap * gap * a[0] * b[0] / n, a[3] + b[3]

    def finish(self, state):
        return state[0], float(state[1]), float(state[2] / state[0]), state[3].tolist()


@query("user_aggregate")
def q_user_aggregate(spark, sf):
    """A user aggregate with a state of its own, per key."""
    rows = _unshifted(spark, sf).select(_era(), F.get("features", 0).alias("a"), F.get("features", 1).alias("b"))
    out = aggregate(rows, Spread(), ["a", "b"], ["era"])
    return out.select("era", "n", _round(F.col("mean"), "mean"), _round(F.col("variance"), "variance"),
                      *(F.get("tenths", i).alias(f"t{i}") for i in range(11)))


# --- split ---------------------------------------------------------------------

@query("split_counts")
def q_split_counts(spark, sf):
    parts = sp.with_part(fx.song_lines(spark, sf), KEY, [0.8, 0.2], ["train", "test"])
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


# --- gradient descent ----------------------------------------------------------

def _gd(spark, sf):
    """Gradient descent as the last stage of the song pipeline, fitted on the
    training lines; returns (model stage, featurised train, featurised test)."""
    lines = fx.song_lines(spark, sf)
    train_l, test_l = sp.hash_split(lines, KEY, [0.8, 0.2])
    stages = fe.song_stages(FEATURES_3) + [GradientDescentRegression(
        featuresCol="features", labelCol="label_shifted", maxIter=GD_ITERS, stepSize=GD_STEP)]
    pm = Pipeline(stages=stages).fit(train_l)
    return pm.stages[-1], pm.transform(train_l), pm.transform(test_l)


@query("gd_weights_parity")
def q_gd_weights_parity(spark, sf):
    """The reference's order: label minimum over ALL rows before the split
    (fixed-offset MinShift), then gradient descent on the training rows.
    Without an intercept this changes the weights."""
    rows = sp.with_part(fx.song_lines(spark, sf), KEY, [0.8, 0.2], ["train", "test"])
    gd = GradientDescentRegression(featuresCol="features", labelCol="label_shifted", maxIter=GD_ITERS, stepSize=GD_STEP)
    folded = fold(fe.song_stages(FEATURES_3), gd, rows)
    parts = moments(folded.rows, "features", folded.label, by="part", mins=folded.low)  # one pass over both parts
    model = gd.fit_moments(folded.shifted(parts["train"], total(parts).mins))
    return model.weights_frame(spark).select(F.col("i"), _round(F.col("weight"), "weight"))


@query("gd_weights")
def q_gd_weights(spark, sf):
    model, _, _ = _gd(spark, sf)
    w = model.weights_frame(spark)
    return w.select(F.col("i"), _round(F.col("weight"), "weight"))


@query("gd_history")
def q_gd_history(spark, sf):
    model, _, _ = _gd(spark, sf)
    h = model.history(spark)
    return h.select("iteration", _round(F.col("rmse"), "rmse"))


@query("gd_final_rmse")
def q_gd_final_rmse(spark, sf):
    """Training RMSE before the last update (the history's last entry) and of
    the returned weights."""
    model, _, _ = _gd(spark, sf)
    row = [(float(model.getTrainingError()[-1]), float(model.getFinalError()))]
    return spark.createDataFrame(row, "last_history double, final double").select(
        _round(F.col("last_history"), "last_history"), _round(F.col("final"), "final"))


@query("gd_gradient")
def q_gd_gradient(spark, sf):
    """The gradient at given weights, from the moments of one pass."""
    train_l, _ = sp.hash_split(fx.song_lines(spark, sf), KEY, [0.8, 0.2])
    gd = GradientDescentRegression(featuresCol="features", labelCol="label_shifted")
    folded = fold(fe.song_stages(FEATURES_3), gd, train_l)
    m = moments(folded.rows, "features", folded.label, mins=folded.low)[None]
    g = folded.shifted(m, m.mins).gradient(np.array(GD_PROBE_W))
    return spark.createDataFrame([tuple(map(float, g))], "g1 double, g2 double, g3 double").select(
        *[_round(F.col(f"g{j}"), f"g{j}") for j in (1, 2, 3)])


@query("gd_predict")
def q_gd_predict(spark, sf):
    model, _, test = _gd(spark, sf)
    return model.transform(test).select("song_id", _round(F.col("prediction"), "prediction"))


@query("gd_test_rmse")
def q_gd_test_rmse(spark, sf):
    model, _, test = _gd(spark, sf)
    m = model.transform(test).agg(*error_aggs("label_shifted", "prediction"))
    return m.select(_round(F.col("rmse"), "rmse"))


# --- elastic net ---------------------------------------------------------------

def _enet(spark, sf, poly: bool = False):
    """Elastic net as the last stage of the song pipeline (optionally after a
    degree-2 expansion), fitted on the training lines."""
    lines = fx.song_lines(spark, sf)
    train_l, test_l = sp.hash_split(lines, KEY, [0.8, 0.2])
    stages = fe.song_stages(FEATURES_3)
    fc = "features"
    if poly:
        stages.append(fe.PolyExpansion(inputCol="features", outputCol="polyfeatures",
                                       degree=2, numFeatures=len(FEATURES_3)))
        fc = "polyfeatures"
    stages.append(ElasticNet(featuresCol=fc, labelCol="label_shifted", regParam=REG,
                             elasticNetParam=ALPHA, maxIter=MAX_ITER))
    pm = Pipeline(stages=stages).fit(train_l)
    return pm.stages[-1], pm.transform(train_l), pm.transform(test_l)


@query("enet_coefficients")
def q_enet_coefficients(spark, sf):
    model, _, _ = _enet(spark, sf)
    return model.terms_frame(spark).select("term", _round(F.col("value"), "value"))


@query("enet_train_metrics")
def q_enet_train_metrics(spark, sf):
    model, train, _ = _enet(spark, sf)
    m = model.evaluate(train)
    return m.select(*[_round(F.col(c), c) for c in ("rmse", "mse", "mae")])


@query("enet_predict")
def q_enet_predict(spark, sf):
    model, _, test = _enet(spark, sf)
    return model.transform(test).select("song_id", _round(F.col("prediction"), "prediction"))


@query("enet_test_rmse")
def q_enet_test_rmse(spark, sf):
    model, _, test = _enet(spark, sf)
    return model.evaluate(test).select(_round(F.col("rmse"), "rmse"))


@query("poly_enet_test_rmse")
def q_poly_enet_test_rmse(spark, sf):
    model, _, test = _enet(spark, sf, poly=True)
    return model.evaluate(test).select(_round(F.col("rmse"), "rmse"))


# --- cross-validation ----------------------------------------------------------

def _cv(spark, sf, poly: bool = False, parity: bool = False):
    """Grid x 3-fold CV of the song pipeline on the training lines. ``parity``
    scores against the unshifted year, like an evaluator left on the default
    label column. Returns (fitted model, training lines, test lines)."""
    train_l, test_l = sp.hash_split(fx.song_lines(spark, sf), KEY, [0.8, 0.2])
    stages = fe.song_stages(FEATURES_3)
    if poly:
        stages.append(fe.PolyExpansion(inputCol="features", outputCol="polyfeatures",
                                       degree=2, numFeatures=len(FEATURES_3)))
    stages.append(ElasticNet(featuresCol="polyfeatures" if poly else "features",
                             labelCol="label_shifted", elasticNetParam=ALPHA))
    cv = CrossValidator(Pipeline(stages=stages), param_grid(GRID_MAX_ITER, GRID_REG), KEY, FOLDS,
                        label_col="label" if parity else None)
    return cv.fit(train_l), train_l, test_l


def _cv_metrics(spark, sf, poly=False, parity=False):
    m = _cv(spark, sf, poly, parity)[0].result.metrics_frame(spark)
    return m.select("max_iter", "reg_param", _round(F.col("avg_rmse"), "avg_rmse"))


def _cv_best(spark, sf, poly=False):
    res = _cv(spark, sf, poly)[0].result
    m = res.metrics_frame(spark)
    best = res.best_params
    return (m.filter((F.col("max_iter") == best["maxIter"])
                     & (F.col("reg_param") == best["regParam"]))
             .select("max_iter", "reg_param", _round(F.col("avg_rmse"), "avg_rmse")))


@query("cv_metrics")
def q_cv_metrics(spark, sf):
    return _cv_metrics(spark, sf)


@query("cv_best")
def q_cv_best(spark, sf):
    return _cv_best(spark, sf)


@query("cv_parity_metrics")
def q_cv_parity_metrics(spark, sf):
    return _cv_metrics(spark, sf, parity=True)


@query("poly_cv_metrics")
def q_poly_cv_metrics(spark, sf):
    return _cv_metrics(spark, sf, poly=True)


@query("poly_cv_best")
def q_poly_cv_best(spark, sf):
    return _cv_best(spark, sf, poly=True)


@query("cv_best_train_metrics")
def q_cv_best_train_metrics(spark, sf):
    """Training summary (rmse, mse, mae) of the best CV setting refitted on
    all training rows."""
    model, train, _ = _cv(spark, sf)
    m = model.transform(train).agg(*error_aggs("label_shifted", "prediction"))
    return m.select(*[_round(F.col(c), c) for c in ("rmse", "mse", "mae")])


@query("cv_best_test_rmse")
def q_cv_best_test_rmse(spark, sf):
    """Hold-out RMSE of the best CV model."""
    model, _, test = _cv(spark, sf)
    return model.transform(test).agg(*error_aggs("label_shifted", "prediction")).select(_round(F.col("rmse"), "rmse"))


@query("poly_cv_best_test_rmse")
def q_poly_cv_best_test_rmse(spark, sf):
    """Hold-out RMSE of the best CV model on degree-2 polynomial features."""
    model, _, test = _cv(spark, sf, poly=True)
    return model.transform(test).agg(*error_aggs("label_shifted", "prediction")).select(_round(F.col("rmse"), "rmse"))


@query("cv_fold_offsets")
def q_cv_fold_offsets(spark, sf):
    """The label minimum learned without each fold, and on all training rows."""
    model = _cv(spark, sf)[0]
    shift = lambda stages: next(s for s in stages if isinstance(s, fe.MinShiftModel)).getOrDefault("offset")
    rows = [(k, float(shift(stages))) for k, stages in enumerate(model.fold_stages)] + [(-1, float(shift(model.best.stages)))]
    return spark.createDataFrame(rows, "fold int, offset double")


@query("gd_cv_metrics")
def q_gd_cv_metrics(spark, sf):
    """Gradient descent tuned by the same cross-validation."""
    train_l, _ = sp.hash_split(fx.song_lines(spark, sf), KEY, [0.8, 0.2])
    stages = fe.song_stages(FEATURES_3) + [GradientDescentRegression(featuresCol="features", labelCol="label_shifted")]
    grid = [{"maxIter": n, "stepSize": s} for n in GD_GRID_ITERS for s in GD_GRID_STEP]
    m = CrossValidator(Pipeline(stages=stages), grid, KEY, FOLDS).fit(train_l).result.metrics_frame(spark)
    return m.select("max_iter", "step_size", _round(F.col("avg_rmse"), "avg_rmse"))
