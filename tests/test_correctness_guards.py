"""Derived tables follow their input; sizes, nulls and limits are checked alike everywhere."""

import math
import shutil
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.functions import vectors as V
from cadenza.functions.metrics import regression_metrics
from cadenza.operators import features as fe
from cadenza.operators import songs, split
from cadenza.operators.gd import GradientDescentRegression
from cadenza.operators.linreg import ElasticNet
from cadenza.operators.stats import moments
from cadenza.plans import fixtures as fx
from cadenza.plans.queries import queries
from cadenza.sources import archive, storage


def rewrite(spark, sf, out, rows):
    """Copies of some input tables, ``rows`` rows each, under one path."""
    for name in ("lineitem", "customer", "pages"):
        target = out / f"{name}.parquet"
        df = spark.read.parquet(f"{sf}/{name}.parquet").limit(rows).coalesce(1)
        fresh = out / f"fresh-{name}"
        df.write.parquet(str(fresh))
        part = next(fresh.glob("part-*.parquet"))
        shutil.copy(part, target)


FOLLOWERS = ["text_scan_count", "song_count", "landed_songs_per_year", "bank_csv_age_counts", "archive_counts",
             "archive_members", "flatten_record", "known_year", "sql_song_count"]


def test_queries_follow_a_rewritten_input(spark, sf, tmp_path):
    found = {}
    for rows in (30, 3000):
        folder = tmp_path / f"n{rows}"
        folder.mkdir()
        rewrite(spark, sf, folder, rows)
        same = tmp_path / "tables"
        same.mkdir(exist_ok=True)
        for f in folder.glob("*.parquet"):
            shutil.copy(f, same / f.name)
        spark.catalog.clearCache()
        found[rows] = {n: sorted(map(tuple, queries()[n](spark, str(same)).collect())) for n in FOLLOWERS}
    for n in FOLLOWERS:
        assert found[30][n] != found[3000][n], n
    assert found[3000]["song_count"] == [(3000,)] and found[3000]["text_scan_count"] == [(3000,)]
    assert len(found[3000]["flatten_record"]) == 3000
    assert sum(r[1] for r in found[3000]["archive_counts"]) == 50  # all pages there are


def test_key_of_a_derived_table(spark, sf, monkeypatch):
    tag = fx.input_tag(spark, sf, "lineitem")
    assert tag == fx.input_tag(spark, sf + "/", "lineitem") != fx.input_tag(spark, sf, "lineitem", 1)
    for name, value in (("YEAR_BASE", 1900), ("FEATURE_COLS", ["f1"]), ("SONG_KEY_COLS", ["l_orderkey"]), ("BANK_HEADER", ["age"])):
        with monkeypatch.context() as m:
            m.setattr(fx, name, value)
            assert fx.input_tag(spark, sf, "lineitem") != tag, name
    assert fx.input_tag(spark, sf, "lineitem") == tag


def test_publishing(spark, tmp_path):
    path = str(tmp_path / "a" / "table")

    def write(n):
        return lambda out: spark.range(n).write.parquet(out)
    storage.publish(spark, path, write(3))
    storage.publish(spark, path, write(5))  # there already
    assert spark.read.parquet(path).count() == 3

    def late(out):  # another driver publishes while this one writes
        write(7)(out)
        storage.publish(spark, path + "2", write(4))
    storage.publish(spark, path + "2", late)
    assert spark.read.parquet(path + "2").count() == 4
    with pytest.raises(RuntimeError):
        storage.publish(spark, path + "3", lambda out: (_ for _ in ()).throw(RuntimeError("failed")))
    assert not storage.exists(spark, path + "3")
    assert not [p for p in (tmp_path / "a").iterdir() if p.name.startswith("_writing") and not p.name.endswith("table3")]


SIZES = [3, 4, 5, 6, 7, 64, 65]


@pytest.mark.parametrize("d", SIZES)
def test_dot_const_checks_sizes(spark, d):
    df = spark.createDataFrame([([1.0] * d,), (None,)], "a array<double>")
    assert [r[0] for r in df.select(V.dot_const("a", [2.0] * d)).collect()] == [2.0 * d, None]
    for wrong in (d - 1, d + 1):
        with pytest.raises(Exception, match="vector sizes differ"):
            df.select(V.dot_const("a", [2.0] * wrong)).collect()


def test_slicer_checks_indices(spark):
    df = spark.createDataFrame([([1.0, 2.0],), (None,)], "tokens_vector array<double>")
    assert [r.features for r in fe.VectorSlicer(inputCol="tokens_vector", outputCol="features", indices=[1, 0]).transform(df).collect()] == [[2.0, 1.0], None]
    with pytest.raises(Exception, match="no element 2"):
        fe.VectorSlicer(inputCol="tokens_vector", outputCol="features", indices=[2]).transform(df).collect()
    sized = fe.VectorSlicer(inputCol="tokens_vector", indices=[0], outputCol="one").transform(df)
    for bad in ([1], [-1]):
        with pytest.raises(ValueError):
            fe.VectorSlicer(inputCol="one", outputCol="two", indices=bad).transform(sized)


def frame(spark, rows):
    return spark.createDataFrame(rows, "x array<double>, y double").repartition(3)


def good_rows(d, n=40):
    rng = np.random.default_rng(d)
    return [(rng.normal(size=d).tolist(), float(rng.normal())) for _ in range(n)]


@pytest.mark.parametrize("d", SIZES)
@pytest.mark.parametrize("fit", ["moments", "gram", "iterative", "elastic net"])
def test_bad_rows_raise_alike(spark, d, fit):
    def run(df):
        if fit == "moments":
            return moments(df, "x", "y", d)
        df = fe.with_vector(df, "x", F.col("x"), d)
        if fit == "elastic net":
            return ElasticNet(featuresCol="x", labelCol="y").fit(df)
        return GradientDescentRegression(featuresCol="x", labelCol="y", maxIter=2, mode=fit).fit(df)

    rows = good_rows(d)
    if d in (3, 65):
        run(frame(spark, rows))
    flaws = {"null": ([None] + [1.0] * (d - 1), 1.0), "nan": ([math.nan] + [1.0] * (d - 1), 1.0),
             "inf": ([math.inf] * d, 1.0), "label": ([1.0] * d, None), "vector": (None, 1.0)}
    for name in (flaws if d in (4, 5) else ["inf"]):
        with pytest.raises(ValueError, match="1 rows with null, NaN or infinite"):
            run(frame(spark, rows + [flaws[name]]))
    with pytest.raises(ValueError, match=f"must all have size {d}: 1 rows"):
        run(frame(spark, rows + [([1.0] * (d + 1), 1.0)]))
    with pytest.raises(ValueError, match="empty training set"):
        run(frame(spark, rows).where("false"))


def test_iterative_descent_equals_gram(spark):
    for d in (3, 20):
        df = frame(spark, good_rows(d, 200))
        models = [GradientDescentRegression(featuresCol="x", labelCol="y", maxIter=15, stepSize=0.3, mode=m).fit(df)
                  for m in ("gram", "iterative")]
        np.testing.assert_allclose(models[0].getWeights(), models[1].getWeights(), rtol=1e-9)
        np.testing.assert_allclose(models[0].getTrainingError(), models[1].getTrainingError(), rtol=1e-9)
        assert math.isclose(models[0].getFinalError(), models[1].getFinalError(), rel_tol=1e-9)


def test_max_iter_is_honoured(spark):
    rng = np.random.default_rng(1)
    z = rng.normal(size=(300, 1))
    x = z + 0.1 * rng.normal(size=(300, 4))  # correlated: slow to converge
    y = x @ [1.0, -2.0, 3.0, 0.5] + rng.normal(size=300)
    df = frame(spark, [(r.tolist(), float(t)) for r, t in zip(x, y)])
    fits = {}
    for rounds in (1, 100):
        with warnings.catch_warnings(record=True) as caught:
            warnings.simplefilter("always")
            fits[rounds] = ElasticNet(featuresCol="x", labelCol="y", regParam=0.01, elasticNetParam=0.5, maxIter=rounds).fit(df)
        assert bool([w for w in caught if "not converged" in str(w.message)]) == (rounds < 100)
    one, full = fits.values()
    assert one.getRounds() == 1 and not one.hasConverged()
    assert full.getRounds() <= 20 and full.hasConverged()
    assert np.abs(np.subtract(one.getCoefficients(), full.getCoefficients())).max() > 1e-6


def test_metrics_need_every_prediction(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, None), (3.0, None)], "label double, prediction double")
    with pytest.raises(Exception, match="2 rows have no label or no prediction"):
        regression_metrics(df)
    got = regression_metrics(df.where("prediction is not null"))
    assert got == {"rmse": 0.5, "mse": 0.25, "mae": 0.5, "n": 1}


def test_split_needs_a_bucket_per_weight(spark):
    df = spark.range(10_000)
    with pytest.raises(ValueError, match="rounds to none"):
        split.hash_split(df, ["id"], [0.996, 0.004])
    parts = [p.count() for p in split.hash_split(df, ["id"], [0.996, 0.004], buckets=1000)]
    assert sum(parts) == 10_000 and 10 < parts[1] < 90
    assert split.hash_split(df, ["id"], [1.0, 0.0])[1].count() == 0


def test_vector_function_rejects_ragged_vectors(spark):
    stage = fe.PandasArrayFn(lambda m: m.sum(axis=1), "x", "s")
    df = frame(spark, [([1.0, 2.0], 0.0), ([3.0, 4.0], 0.0)]).coalesce(1)
    assert sorted(r.s for r in stage.transform(df).collect()) == [3.0, 7.0]
    assert stage.transform(df.where("false")).collect() == []
    for odd in ([1.0], None):
        with pytest.raises(Exception, match="one size"):
            stage.transform(df.union(frame(spark, [(odd, 0.0)])).coalesce(1)).collect()


def test_reject_counts(spark):
    lines = spark.createDataFrame([("2001.0,1,2,3,9",), ("x,1,2,3,9",), ("2001,,y,3",), ("2001",), (None,), ("1999,z,z,3,q",)],
                                  "value string")
    assert tuple(songs.reject_counts(lines).first()) == (6, 3, 1, 1, 2, 0)


@pytest.fixture()
def archives(spark, tmp_path):
    df = spark.range(30).select((F.col("id") % 3).alias("g"), F.concat(F.col("id").cast("string"), F.lit(".h5")).alias("n"),
                                F.repeat(F.lit("ab"), F.col("id").cast("int")).alias("c"))
    packed = archive.pack_archives(df, "g", "n", "c")
    assert archive.write_files(packed, str(tmp_path)) == 3
    before = sorted((p.name, p.stat().st_mtime_ns) for p in tmp_path.iterdir())
    assert archive.write_files(packed, str(tmp_path)) == 3  # a second attempt leaves the first one's files
    assert sorted((p.name, p.stat().st_mtime_ns) for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == before
    return str(tmp_path) + "/*.tar.gz"


def test_archives_without_content_and_of_any_size(spark, archives, monkeypatch):
    full = archive.read_archives(spark, archives)
    want = sorted((r.member, r.size) for r in full.collect())
    assert len(want) == 30 and full.columns == ["path", "member", "size", "content"]
    names = archive.read_archives(spark, archives, content=False)
    assert names.columns == ["path", "member", "size"]
    assert sorted((r.member, r.size) for r in names.collect()) == want
    monkeypatch.setattr(archive, "CELL_BYTES", 0)  # every archive counts as too large for a cell
    for content in (True, False):
        rows = archive.read_archives(spark, archives, content=content)
        assert sorted((r.member, r.size) for r in rows.collect()) == want
    with pytest.raises(FileNotFoundError):
        archive.read_archives(spark, archives + ".none")


def test_cut_archives_raise(spark, tmp_path, archives):
    import glob
    whole = open(glob.glob(archives)[0], "rb").read()
    df = spark.createDataFrame([("a", bytearray(whole[:len(whole) // 2]))], "path string, content binary")
    for content in (True, False):
        with pytest.raises(Exception):
            archive.extract_members(df, content=content).collect()
    (tmp_path / "cut.tar.gz").write_bytes(whole[:len(whole) // 2])
    for content in (True, False):
        with pytest.raises(Exception):
            archive.read_archives_streaming(spark, [str(tmp_path / "cut.tar.gz")], content=content).collect()


def test_feature_queries_learn_nothing(spark, sf):
    """No job runs before the result is asked for."""
    fx.song_lines(spark, sf)
    sc = spark.sparkContext
    for name in ("label_slice", "poly_features", "min_label", "top_row", "vector_dot", "vector_scale", "vector_add",
                 "vector_sum"):
        sc.setJobGroup(f"lazy-{name}", name)
        queries()[name](spark, sf)
        assert not sc.statusTracker().getJobIdsForGroup(f"lazy-{name}"), name
    sc.setJobGroup("", "")


def test_pipeline_cross_validation(spark, sf):
    """The fitted pipeline scores raw lines; a label that is not a shift is refused."""
    from pyspark.ml import Pipeline

    from cadenza.operators.tuning import CrossValidator, param_grid
    train, test = split.hash_split(fx.song_lines(spark, sf), ["song_id"], [0.8, 0.2])
    stages = fe.song_stages([1, 2, 3]) + [ElasticNet(featuresCol="features", labelCol="label_shifted", elasticNetParam=0.1)]
    cv = CrossValidator(Pipeline(stages=stages), param_grid([20, 50], [0.4, 1.2]), ["song_id"])
    model = cv.fit(train)
    scored = model.transform(test)
    assert scored.count() == test.count() and "prediction" in scored.columns
    assert len(model.result.avg_metrics) == 4 and len(model.result.fold_metrics) == 3
    shifted = CrossValidator(Pipeline(stages=stages), cv.grid, ["song_id"], label_col="label").fit(train).result
    assert min(shifted.avg_metrics) > max(model.result.avg_metrics)
    with pytest.raises(ValueError, match="plus a constant"):
        odd = fe.ColumnFn(lambda c: c * 2, "label", "twice")
        CrossValidator(Pipeline(stages=[*stages[:-1], odd, stages[-1]]), cv.grid, ["song_id"], label_col="twice").fit(train)
    with pytest.raises(TypeError):
        CrossValidator(Pipeline(stages=stages[:-1]), cv.grid, ["song_id"])
