import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from cadenza.functions import vectors as V
from cadenza.operators import features as fe
from cadenza.plans import fixtures as fx
from cadenza.sources import memory


def test_vector_ops(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 5.0, 6.0])], "a array<double>, b array<double>")
    r = df.select(V.dot("a", "b").alias("d"), V.add("a", "b").alias("s"),
                  V.scale("a", 2.0).alias("k"), V.fill(3, 0.5).alias("f"),
                  V.dot_const("a", [1.0, 0.0, -1.0]).alias("c"),
                  V.slice_indices("b", [2, 0]).alias("sl")).first()
    assert r["d"] == 32.0 and r["s"] == [5.0, 7.0, 9.0] and r["k"] == [2.0, 4.0, 6.0]
    assert r["f"] == [0.5, 0.5, 0.5] and r["c"] == -2.0 and r["sl"] == [6.0, 4.0]


def test_vector_size_mismatch_raises(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0])], "a array<double>, b array<double>")
    with pytest.raises(Exception):
        df.select(V.dot("a", "b")).collect()
    with pytest.raises(Exception):
        df.select(V.add("a", "b")).collect()


def test_vector_sum_agg(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0],)], "a array<double>")
    r = df.agg(*V.sum_agg("a", 2)).first()
    assert (r["s0"], r["s1"]) == (4.0, 6.0)


def test_tokenizer_lowercases_and_drops_empty(spark):
    df = memory.from_lines(spark, ["2001.0,,NaN,0.5"])
    toks = fe.Tokenizer(inputCol="value", outputCol="t", pattern=",").transform(df).first()["t"]
    assert toks == ["2001.0", "nan", "0.5"]  # the empty field shifts later tokens
    vec = fe.ArrayToVector(inputCol="t", outputCol="v").transform(
        spark.createDataFrame([(toks,)], "t array<string>")).first()["v"]
    assert vec[0] == 2001.0 and np.isnan(vec[1]) and vec[2] == 0.5


def test_tokenizer_matches_mllib(spark, sf):
    from pyspark.ml.feature import RegexTokenizer
    lines = fx.song_lines(spark, sf)
    ours = fe.Tokenizer(inputCol="value", outputCol="a", pattern=",").transform(lines)
    both = RegexTokenizer(inputCol="value", outputCol="b", pattern=",").transform(ours)
    assert both.filter(F.col("a") != F.col("b")).count() == 0


def test_poly_terms_order():
    assert fe.poly_terms(3, 2) == [(1, 0, 0), (2, 0, 0), (0, 1, 0), (1, 1, 0), (0, 2, 0),
                                   (0, 0, 1), (1, 0, 1), (0, 1, 1), (0, 0, 2)]
    assert len(fe.poly_terms(4, 3)) == 34


@pytest.mark.parametrize("n,degree", [(3, 2), (2, 3), (4, 2)])
def test_poly_expansion_matches_mllib(spark, n, degree):
    from pyspark.ml.feature import PolynomialExpansion
    from pyspark.ml.functions import array_to_vector, vector_to_array
    rng = np.random.default_rng(n * 10 + degree)
    rows = [(list(map(float, rng.uniform(-2, 2, n))),) for _ in range(20)]
    df = spark.createDataFrame(rows, "x array<double>")
    ours = fe.PolyExpansion(inputCol="x", outputCol="p", degree=degree, numFeatures=n).transform(df)
    ml = PolynomialExpansion(inputCol="xv", outputCol="pv", degree=degree).transform(
        ours.withColumn("xv", array_to_vector("x")))
    for r in ml.select("p", vector_to_array("pv").alias("q")).collect():
        np.testing.assert_allclose(r["p"], r["q"], rtol=1e-12, atol=1e-12)


def test_slicer_matches_mllib(spark, sf):
    from pyspark.ml.feature import VectorSlicer as MLSlicer
    from pyspark.ml.functions import array_to_vector, vector_to_array
    f = Pipeline(stages=fe.song_stages([1, 2, 3])).fit(fx.song_lines(spark, sf)).transform(
        fx.song_lines(spark, sf))
    ml = MLSlicer(inputCol="tv", outputCol="fv", indices=[1, 2, 3]).transform(
        f.withColumn("tv", array_to_vector("tokens_vector")))
    bad = ml.filter(F.col("features") != vector_to_array("fv")).count()
    assert bad == 0


def test_min_shift_learns_min_and_fixed_offset(spark, sf):
    lines = fx.song_lines(spark, sf)
    f = Pipeline(stages=fe.song_stages([1, 2, 3])).fit(lines).transform(lines)
    assert f.agg(F.min("label_shifted")).first()[0] == 0.0
    fixed = Pipeline(stages=fe.song_stages([1, 2, 3], label_offset=1922.0)).fit(lines)
    shift = fixed.stages[4]
    assert shift.getOrDefault("offset") == 1922.0
    m = fixed.transform(lines).agg(F.min("label"), F.min("label_shifted")).first()
    assert m[1] == m[0] - 1922.0


def test_min_shift_empty_raises(spark):
    df = spark.createDataFrame([], "label double")
    with pytest.raises(ValueError):
        fe.MinShift(inputCol="label", outputCol="s").fit(df)


def test_column_fn_stage(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    st = fe.ColumnFn(lambda c: c * 2 + 1, "x", "y")
    assert [r["y"] for r in st.copy().transform(df).collect()] == [3.0, 7.0]


def test_pipeline_is_one_projection(spark, sf):
    lines = fx.song_lines(spark, sf)
    f = Pipeline(stages=fe.song_stages([1, 2, 3], label_offset=1922.0)).fit(lines).transform(lines)
    plan = f.select("label_shifted", "features")._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan


def test_pandas_array_fn_stage(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 5.0],)], "v array<double>")
    st = fe.PandasArrayFn(lambda m: m[:, 0] * 10 + m[:, 1], "v", "y")
    assert sorted(r["y"] for r in st.transform(df).collect()) == [12.0, 35.0]


def test_pipeline_model_save_load(spark, sf, tmp_path):
    from pyspark.ml import PipelineModel
    from cadenza.operators.gd import GradientDescentRegression
    from cadenza.operators.linreg import ElasticNet
    lines = fx.song_lines(spark, sf)
    stages = fe.song_stages([1, 2, 3]) + [
        fe.PolyExpansion(inputCol="features", outputCol="poly", degree=2, numFeatures=3),
        ElasticNet(featuresCol="poly", labelCol="label_shifted", regParam=0.9,
                   elasticNetParam=0.1, predictionCol="p_en"),
        GradientDescentRegression(featuresCol="features", labelCol="label_shifted",
                                  predictionCol="p_gd")]
    pm = Pipeline(stages=stages).fit(lines)
    path = str(tmp_path / "model")
    pm.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = pm.transform(lines).select("p_en", "p_gd").collect()
    b = back.transform(lines).select("p_en", "p_gd").collect()
    assert a == b
    assert back.stages[4].getOrDefault("offset") == pm.stages[4].getOrDefault("offset")


def test_schema_and_show(spark, sf, capsys):
    from cadenza.operators import songs
    s = songs.parse_songs(fx.song_lines(spark, sf))
    s.printSchema()
    s.show(3)
    out = capsys.readouterr().out
    assert "|-- year: integer" in out and "|-- f3: double" in out and "only showing top 3 rows" in out
    assert [f.name for f in s.schema.fields] == ["song_id", "year", "f1", "f2", "f3"]


def test_parquet_songs_get_pushed_filters(spark, sf, tmp_path):
    from cadenza.operators import profile, songs
    path = str(tmp_path / "songs.parquet")
    songs.parse_songs(fx.song_lines(spark, sf)).write.parquet(path)
    q = profile.count_between(spark.read.parquet(path), "year", 1998, 2000)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(year), GreaterThanOrEqual(year,1998), LessThanOrEqual(year,2000)]" in plan
    assert "ReadSchema: struct<year:int>" in plan


def test_dot_const_long_vectors_use_one_expression(spark):
    rng = np.random.default_rng(7)
    x = list(map(float, rng.normal(size=200)))
    w = list(map(float, rng.normal(size=200)))
    df = spark.createDataFrame([(x,)], "a array<double>")
    got = df.select(V.dot_const("a", w).alias("d")).first()["d"]
    assert got == pytest.approx(float(np.dot(x, w)), rel=1e-12)
    got3 = df.select(V.dot_const(F.slice("a", 1, 3), w[:3]).alias("d")).first()["d"]
    assert got3 == pytest.approx(float(np.dot(x[:3], w[:3])), rel=1e-12)


@pytest.mark.parametrize("min_len", [0, 1, 2])
def test_tokenizer_token_lengths_match_mllib(spark, min_len):
    from pyspark.ml.feature import RegexTokenizer
    lines = ["a,,b,,", ",,", "", "x", ",lead,,mid,", "AB,cd,,e,fgh,,,"]
    df = memory.from_lines(spark, lines)
    ours = fe.Tokenizer(inputCol="value", outputCol="a", pattern=",",
                        minTokenLength=min_len).transform(df)
    both = RegexTokenizer(inputCol="value", outputCol="b", pattern=",",
                          minTokenLength=min_len).transform(ours)
    for r in both.collect():
        assert r["a"] == r["b"], (r["value"], r["a"], r["b"])


def test_function_stages_refuse_to_save(tmp_path):
    for st in (fe.ColumnFn(lambda c: c, "x", "y"), fe.PandasArrayFn(lambda m: m[:, 0], "v", "y")):
        with pytest.raises(NotImplementedError):
            st.write().save(str(tmp_path / "s"))
