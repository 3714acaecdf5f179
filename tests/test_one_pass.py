"""User aggregates, one-pass fits, cross-validation per fold and the converging elastic net."""

import math
import sys
import warnings

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml import Pipeline as MLPipeline
from pyspark.sql import functions as F

from cadenza.operators import features as fe
from cadenza.operators import split, stats
from cadenza.operators.aggregate import Aggregator, aggregate, reduce_by
from cadenza.operators.gd import GradientDescentRegression
from cadenza.operators.linreg import ElasticNet, solve, violation
from cadenza.operators.pipeline import Pipeline, fold
from cadenza.operators.tuning import CrossValidatedModel, CrossValidator, param_grid
from cadenza.plans import fixtures as fx

# workers do not import the tests
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def counted(spark, df):
    """The rows, and how many of them have been read so far."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return df.mapInArrow(run, df.schema), seen


def models():
    poly = fe.PolyExpansion(inputCol="features", outputCol="polyfeatures", degree=2, numFeatures=3)
    return {"enet": ([], ElasticNet(featuresCol="features", labelCol="label_shifted", regParam=0.9, elasticNetParam=0.1)),
            "poly": ([poly], ElasticNet(featuresCol="polyfeatures", labelCol="label_shifted", regParam=0.9, elasticNetParam=0.1)),
            "gd": ([], GradientDescentRegression(featuresCol="features", labelCol="label_shifted")),
            "unshifted": ([], GradientDescentRegression(featuresCol="features", labelCol="label", stepSize=0.1))}


@pytest.mark.parametrize("name", models())
def test_a_fit_reads_its_rows_once(spark, sf, name):
    more, model = models()[name]
    stages = [*fe.song_stages([1, 2, 3]), *more, model]
    lines = fx.song_lines(spark, sf)
    rows, seen = counted(spark, lines)
    one = Pipeline(stages=stages).fit(rows)
    assert seen.value == lines.count()
    staged = MLPipeline(stages=stages).fit(lines)
    for a, b in zip(one.stages[-1].linear_terms(), staged.stages[-1].linear_terms(), strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-7, atol=1e-9)
    assert one.stages[4].getOrDefault("offset") == staged.stages[4].getOrDefault("offset")
    got, want = (m.transform(lines).agg(F.sum("prediction")).first()[0] for m in (one, staged))
    assert math.isclose(got, want, rel_tol=1e-9)


def test_stages_that_need_the_shift_are_fitted_in_turn(spark, sf):
    lines = fx.song_lines(spark, sf)
    square = fe.ColumnFn(lambda c: c * c, "label_shifted", "squared")
    gd = GradientDescentRegression(featuresCol="features", labelCol="squared", stepSize=0.1)
    stages = [*fe.song_stages([1, 2, 3]), square]
    assert fold(stages, gd, lines) is None
    one, staged = (p(stages=[*stages, gd]).fit(lines).stages[-1].getWeights() for p in (Pipeline, MLPipeline))
    assert one == staged
    # a later stage that gives the label anew, and an input that already has the names used
    again = fe.ColumnFn(lambda c: c - 1900, "label", "label_shifted")
    gd = GradientDescentRegression(featuresCol="features", labelCol="label_shifted", stepSize=0.1)
    odd = lines.withColumn("label_shifted", F.lit("x")).withColumn("_low", F.lit(1))
    one, staged = (p(stages=[*fe.song_stages([1, 2, 3]), again, gd]).fit(odd).stages[-1].getWeights() for p in (Pipeline, MLPipeline))
    np.testing.assert_allclose(one, staged, rtol=1e-12)
    with pytest.raises(ValueError, match="empty"):
        Pipeline(stages=[*fe.song_stages([1, 2, 3]), gd]).fit(lines.where("false"))


@pytest.mark.parametrize("wide", [False, True])
def test_minima_come_with_the_moments(spark, monkeypatch, wide):
    monkeypatch.setattr(stats, "WIDE_D", 0 if wide else 4)
    df = spark.createDataFrame([([1.0, 2.0], 3.0, "a", 5.0), ([2.0, 2.0], 4.0, "a", None), ([0.0, 7.0], -1.0, None, None)],
                               "x array<double>, y double, g string, z double")
    got = stats.moments(df, "x", "y", by="g", mins=[F.col("z"), F.col("y") * 2])
    assert {g: m.mins for g, m in got.items()} == {"a": (5.0, 6.0), None: (None, -2.0)}
    assert stats.total(got).mins == (5.0, -2.0) and stats.total(got).n == 3


# --- cross-validation ---------------------------------------------------------------

def refit(stages, estimator, grid, rows, folds, scored):
    """Average RMSE per grid point by fitting everything on the other folds' rows."""
    out = []
    for g in grid:
        found = []
        for k in range(folds):
            params = {estimator.getParam(n): v for n, v in g.items()}
            model = MLPipeline(stages=[*stages, estimator.copy(params)]).fit(rows.where(F.col("fold") != k))
            done = model.transform(rows.where(F.col("fold") == k))
            found.append(done.agg(F.sqrt(F.avg((F.col(scored) - F.col("prediction")) ** 2))).first()[0])
        out.append(sum(found) / folds)
    return out


@pytest.mark.parametrize("name,scored", [("gd", "label_shifted"), ("gd", "label"), ("poly", "label_shifted"), ("enet", "label")])
def test_nothing_is_learned_on_the_held_out_fold(spark, sf, name, scored):
    lines = fx.song_lines(spark, sf)
    more, model = models()[name]
    stages = [*fe.song_stages([1, 2, 3]), *more]
    grid = [{"maxIter": n} for n in (1, 30)]
    rows, seen = counted(spark, lines)
    cv = CrossValidator(Pipeline(stages=[*stages, model]), grid, ["song_id"], label_col=scored).fit(rows)
    assert seen.value == lines.count()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = refit(stages, model, grid, split.with_fold(lines, ["song_id"], 3), 3, scored)
    np.testing.assert_allclose(cv.result.avg_metrics, want, rtol=1e-7)
    offsets = [s[4].getOrDefault("offset") for s in cv.fold_stages]
    assert min(offsets) == cv.best.stages[4].getOrDefault("offset")


def test_cross_validation_of_any_estimator(spark, sf):
    """A stage that is learned otherwise, and a model that does not fit on moments."""
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.regression import LinearRegression
    lines = fx.song_lines(spark, sf).limit(1500)
    to_vec = [fe.ToMLVector(inputCol="features", outputCol="v"), StandardScaler(inputCol="v", outputCol="s")]
    lr = LinearRegression(featuresCol="s", labelCol="label_shifted", elasticNetParam=0.1)
    grid = [{"regParam": 0.1}, {"regParam": 5.0}]
    stages = fe.song_stages([1, 2, 3]) + to_vec
    cv = CrossValidator(MLPipeline(stages=[*stages, lr]), grid, ["song_id"], folds=2).fit(lines)
    want = refit(stages, lr, grid, split.with_fold(lines, ["song_id"], 2), 2, "label_shifted")
    np.testing.assert_allclose(cv.result.avg_metrics, want, rtol=1e-9)
    scaled = [*fe.song_stages([1, 2, 3]), *to_vec, fe.FromMLVector(inputCol="s", outputCol="back")]
    gd = GradientDescentRegression(featuresCol="back", labelCol="label_shifted", stepSize=0.05)
    cv = CrossValidator(MLPipeline(stages=[*scaled, gd]), [{"maxIter": 5}], ["song_id"], folds=2, label_col="label").fit(lines)
    want = refit(scaled, gd, [{"maxIter": 5}], split.with_fold(lines, ["song_id"], 2), 2, "label")
    np.testing.assert_allclose(cv.result.avg_metrics, want, rtol=1e-7)


def test_cross_validated_model_is_saved(spark, sf, tmp_path):
    lines = fx.song_lines(spark, sf)
    more, model = models()["enet"]
    cv = CrossValidator(Pipeline(stages=[*fe.song_stages([1, 2, 3]), *more, model]), param_grid([20], [0.4, 1.2]), ["song_id"]).fit(lines)
    cv.save(str(tmp_path / "cv"))
    back = CrossValidatedModel.load(str(tmp_path / "cv"))
    assert back.result.grid == cv.result.grid and back.result.best_index == cv.result.best_index
    assert back.result.fold_metrics == cv.result.fold_metrics and back.result.avg_metrics == cv.result.avg_metrics
    a, b = (m.transform(lines).agg(F.sum("prediction")).first()[0] for m in (cv, back))
    assert a == b


# --- elastic net ----------------------------------------------------------------------

def test_collinear_terms_converge_at_every_grid_point(spark, sf):
    """Nine polynomial terms: no warning, and MLlib's coefficients."""
    lines = fx.song_lines(spark, sf.replace("sf0.001", "sf0.01"))  # MLlib divides by n - 1, which shows in few rows
    stages = [*fe.song_stages([1, 2, 3]), fe.PolyExpansion(inputCol="features", outputCol="p", degree=2, numFeatures=3)]
    rows = MLPipeline(stages=stages).fit(lines).transform(lines).select("p", "label_shifted").persist()
    m = stats.moments(rows, "p", "label_shifted")[None]
    for reg in (0.4, 0.6, 0.8, 0.9, 1.0, 1.2, 1.4):
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            ours = ElasticNet(featuresCol="p", labelCol="label_shifted", regParam=reg, elasticNetParam=0.1, maxIter=20).fit_moments(m)
        assert ours.hasConverged() and ours.getRounds() <= 20
        from pyspark.ml.functions import array_to_vector
        from pyspark.ml.regression import LinearRegression
        lr = LinearRegression(featuresCol="v", labelCol="label_shifted", regParam=reg, elasticNetParam=0.1, maxIter=500, tol=1e-12)
        theirs = lr.fit(rows.select(array_to_vector("p").alias("v"), "label_shifted"))
        np.testing.assert_allclose(ours.getCoefficients(), theirs.coefficients.toArray(), rtol=1e-5, atol=1e-5)
        assert math.isclose(ours.getIntercept(), theirs.intercept, rel_tol=1e-5, abs_tol=1e-5)
    rows.unpersist()


@pytest.mark.parametrize("d,rank", [(5, 5), (40, 12), (200, 30)])
def test_solution_meets_the_optimality_conditions(d, rank):
    """Also where features are copies of each other."""
    rng = np.random.default_rng(d)
    x = rng.normal(size=(300, rank)) @ rng.normal(size=(rank, d)) + 0.01 * rng.normal(size=(300, d))
    y = x[:, 0] - 2 * x[:, 1] + rng.normal(size=300)
    z = np.column_stack([x, y])
    m = stats.Moments(300, z.mean(axis=0), np.cov(z.T, bias=True))
    for reg, alpha in ((0.01, 0.5), (0.5, 0.1), (0.05, 1.0), (5.0, 0.9)):
        found = solve(m, reg, alpha)
        assert found.converged and found.rounds < 200
        sd = np.sqrt(np.diag(m.cov))
        R, r = m.cov[:d, :d] / np.outer(sd[:d], sd[:d]), m.cov[:d, d] / (sd[:d] * sd[d])
        lam = reg / sd[d]
        assert violation(R, r, lam * alpha, lam * (1 - alpha), found.coef * sd[:d] / sd[d]) < 1e-10


# --- user aggregates --------------------------------------------------------------------

class Longest(Aggregator):
    """The longest text and how many rows there are."""

    schema = "longest string, n long"

    def zero(self):
        return None, 0

    def update(self, state, rows):
        found = [v for v in rows.column("t").to_pylist() if v is not None]
        return self.merge(state, (max(found, key=lambda v: (len(v), v), default=None), rows.num_rows))

    def merge(self, a, b):
        pick = max((v for v in (a[0], b[0]) if v is not None), key=lambda v: (len(v), v), default=None)
        return pick, a[1] + b[1]

    def finish(self, state):
        return state


@pytest.mark.parametrize("fan_in,parts", [(1, 1), (3, 40), (32, 7)])
def test_aggregate_by_key(spark, fan_in, parts):
    """A hot key, null keys, two key columns and any partitioning."""
    rows = [("hot" if i % 3 else None if i % 2 else f"k{i % 11}", i % 2, "x" * (i % 17) if i % 5 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "k0 string, state int, t string").repartition(parts)
    out = aggregate(df, Longest(), ["t"], ["k0", "state"], fan_in)
    want = {}
    for k, s, t in rows:
        best, n = want.get((k, s), (None, 0))
        want[k, s] = (t if t is not None and (best is None or len(t) > len(best)) else best, n + 1)
    assert out.columns == ["k0", "state", "longest", "n"]
    assert {(r[0], r[1]): (r[2], r[3]) for r in out.collect()} == want


def test_aggregate_without_keys_and_without_rows(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("t"))
    assert [tuple(r) for r in aggregate(df, Longest(), ["t"]).collect()] == [("999", 1000)]
    assert aggregate(df.where("false"), Longest(), ["t"]).collect() == []


def test_many_keys_are_passed_on_and_merged_again(spark, monkeypatch):
    from cadenza.operators import aggregate as module
    monkeypatch.setattr(module, "HELD_KEYS", 10)
    df = spark.range(2000).select((F.col("id") % 500).alias("k"), F.lit("a").alias("t"))
    assert {r.n for r in aggregate(df, Longest(), ["t"], ["k"]).collect()} == {4}


def test_a_state_over_its_bound_raises(spark):
    class Small(Longest):
        state_bytes = 100
    df = spark.createDataFrame([("x" * 500,)], "t string")
    with pytest.raises(Exception, match="larger than state_bytes"):
        aggregate(df, Small(), ["t"]).collect()


def test_reduce_by(spark):
    df = spark.createDataFrame([("a", 12), ("a", 18), ("b", None), (None, 7), ("a", None)], "k string, v long")
    assert {r.k: r.value for r in reduce_by(df, "v", math.gcd, ["k"]).collect()} == {"a": 6, "b": None, None: 7}
