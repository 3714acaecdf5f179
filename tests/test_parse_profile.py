import pytest
from pyspark.sql import functions as F

from cadenza.functions import parse as P
from cadenza.operators import profile, songs
from cadenza.plans import fixtures as fx
from cadenza.sources import delimited, memory, text

# Fixed unit fixture: the nine inline bank rows with their quoted header.
BANK_TEXT = [
    '"age";"job";"marital";"education";"default";"balance";"housing";"loan";"contact";"day";"month";"duration";"campaign";"pdays";"previous";"poutcome";"y"',
    '30;"unemployed";"married";"primary";"no";1787;"no";"no";"cellular";19;"oct";79;1;-1;0;"unknown";"no"',
    '33;"services";"married";"secondary";"no";4789;"yes";"yes";"cellular";11;"may";220;1;339;4;"failure";"no"',
    '35;"management";"single";"tertiary";"no";1350;"yes";"no";"cellular";16;"apr";185;1;330;1;"failure";"no"',
    '30;"management";"married";"tertiary";"no";1476;"yes";"yes";"unknown";3;"jun";199;4;-1;0;"unknown";"no"',
    '59;"blue-collar";"married";"secondary";"no";0;"yes";"no";"unknown";5;"may";226;1;-1;0;"unknown";"no"',
    '35;"management";"single";"tertiary";"no";747;"no";"no";"cellular";23;"feb";141;2;176;3;"failure";"no"',
    '36;"self-employed";"married";"tertiary";"no";307;"yes";"no";"cellular";14;"may";341;1;330;2;"other";"no"',
    '39;"technician";"married";"secondary";"no";147;"yes";"no";"cellular";6;"may";151;2;-1;0;"unknown";"no"',
    '41;"entrepreneur";"married";"tertiary";"no";221;"yes";"no";"unknown";14;"may";57;2;-1;0;"unknown";"no"',
]
BANK_GOLDEN = [(30, 2), (33, 1), (35, 2), (36, 1), (39, 1), (41, 1), (59, 1)]


def test_bank_golden_from_lines(spark):
    bank = delimited.parse_delimited(memory.from_lines(spark, BANK_TEXT))
    assert bank.columns == ["age", "job", "marital", "education", "balance"]
    out = profile.counts_by(bank, "age", where=F.col("age") < 70, name="cnt", order=True)
    assert [tuple(r) for r in out.collect()] == BANK_GOLDEN
    first = bank.orderBy("age", "balance").first()
    assert first["job"] == "management" and first["balance"] == 1476


def test_bank_golden_from_file(spark, tmp_path):
    p = tmp_path / "bank.csv"
    p.write_text("\n".join(BANK_TEXT) + "\n")
    bank = delimited.read_delimited(spark, str(p))
    out = profile.counts_by(bank, "age", where=F.col("age") < 70, name="cnt", order=True)
    assert [tuple(r) for r in out.collect()] == BANK_GOLDEN


def test_quoted_delimiter_and_escaped_quote(spark):
    head = BANK_TEXT[0]
    row = '30;"a;b";"x""y";"primary";"no";5;"no";"no";"cellular";1;"oct";1;1;-1;0;"u";"no"'
    bank = delimited.parse_delimited(memory.from_lines(spark, [head, row]))
    r = bank.first()
    assert r["job"] == "a;b" and r["marital"] == 'x"y' and r["balance"] == 5


def test_split_keeps_trailing_empty_fields(spark):
    df = memory.from_lines(spark, ["1,2,,", "3"])
    out = df.select(F.size(P.split_fields("value")).alias("n"),
                    P.field(P.split_fields("value"), 5).alias("missing")).collect()
    assert [r["n"] for r in out] == [4, 1]
    assert all(r["missing"] is None for r in out)


def test_strict_cast_raises_lenient_gives_null(spark):
    df = memory.from_lines(spark, ["2001.0,0.5,0.1,0.2", "bad,0.5,0.1,0.2"])
    with pytest.raises(Exception):
        songs.parse_songs(df).collect()
    rows = songs.parse_songs(df, strict=False).orderBy("f1").collect()
    years = sorted([r["year"] for r in rows], key=lambda v: (v is None, v))
    assert years == [2001, None]


def test_year_truncates_toward_zero(spark):
    df = memory.from_lines(spark, ["2001.9,1,2,3", "-3.7,1,2,3"])
    assert sorted(r["year"] for r in songs.parse_songs(df).collect()) == [-3, 2001]


def test_nan_to_zero_keeps_null(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.5,)], "x double")
    got = [r[0] for r in df.select(P.nan_to_zero("x")).collect()]
    assert got == [0.0, None, 1.5]


def test_profile_matches_rdd_style_answers(spark, sf):
    s = songs.parse_songs(fx.song_lines(spark, sf)).cache()
    n = profile.count_rows(s).first()["n"]
    assert n == s.count() > 0
    prof = profile.column_profile(s, "year").first()
    years = [r["year"] for r in s.select("year").collect()]
    assert prof["max_year"] == max(years) and prof["min_year"] == min(years)
    assert prof["avg_year_trunc"] == sum(years) // len(years)
    assert abs(prof["avg_year"] - sum(years) / len(years)) < 1e-9
    per_year = {r["year"]: r["c"] for r in profile.counts_by(
        s, "year", where=F.col("year").between(2000, 2010), name="c").collect()}
    expected = {}
    for y in years:
        if 2000 <= y <= 2010:
            expected[y] = expected.get(y, 0) + 1
    assert per_year == expected
    many = profile.count_where(s, {"a": F.col("year") >= 1998, "b": F.col("year") < 1998}).first()
    assert many["a"] + many["b"] == n
    s.unpersist()


def test_text_round_trip(spark, sf, tmp_path):
    lines = fx.song_lines(spark, sf, with_id=False)
    path = text.materialize_lines(spark, lines, str(tmp_path / "lines"))
    back = text.read_lines(spark, path)
    assert back.count() == lines.count()
    # values parse back to the same numbers
    a = songs.parse_songs(back, n_features=12).agg(F.sum("f12"), F.sum("year")).first()
    b = songs.parse_songs(lines, n_features=12).agg(F.sum("f12"), F.sum("year")).first()
    assert a[1] == b[1] and abs(a[0] - b[0]) < 1e-6


def test_top_row_is_min_label_then_vector(spark, sf):
    from cadenza.plans.queries_ml import _featurized
    f = _featurized(spark, sf)
    top = profile.top_row(f, ["label", "tokens_vector"]).first()
    assert top["label"] == f.agg(F.min("label")).first()[0]
    ties = f.filter(F.col("label") == top["label"]).select("tokens_vector").collect()
    assert min(tuple(r[0]) for r in ties) == tuple(top["tokens_vector"])


def test_landed_songs_prune_partitions(spark, sf):
    import __spark_entry__ as E
    df = E.queries()["landed_songs_per_year"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan
    assert "ReadSchema: struct<>" in plan  # counting needs no data columns
    direct = E.queries()["songs_per_year"](spark, sf)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, direct.collect()))


def test_typed_songs_match_declared_schema(spark, sf):
    s = songs.parse_songs(fx.song_lines(spark, sf)).drop("song_id")
    assert [(f.name, f.dataType) for f in s.schema.fields] == \
        [(f.name, f.dataType) for f in songs.SONG_SCHEMA.fields]


def test_counts_pre_aggregate_before_the_shuffle(spark):
    # one key holds a third of the rows: the map side combines it before the exchange
    df = spark.range(0, 30000).select((F.when(F.col("id") % 3 == 0, F.lit(2000))
                                       .otherwise(F.col("id") % 50)).alias("year"))
    out = profile.counts_by(df, "year", name="c")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    got = {r["year"]: r["c"] for r in out.collect()}
    assert got[2000] == 10000 and sum(got.values()) == 30000


def test_text_lines_gzip_round_trip(spark, sf, tmp_path):
    lines = fx.song_lines(spark, sf, with_id=False)
    path = text.write_lines(lines, str(tmp_path / "gz"), compression="gzip")
    import glob
    assert glob.glob(path + "/*.txt.gz")
    back = text.read_lines(spark, path)
    assert back.count() == lines.count()
    assert back.exceptAll(lines).count() == 0
