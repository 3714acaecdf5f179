"""Registered queries for archives and nested records (the archive program):
pages packed into tar.gz files in the shared folder and read back member by
member; song records flattened, cleaned, filtered and fed to the
regression with the fixed year offset."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import fixtures as fx
from ..operators import features as fe
from ..operators import split as sp
from ..operators.linreg import ElasticNet
from ..operators.pipeline import Pipeline
from ..functions.parse import nan_to_zero
from ..sources import archive, records, restart, storage
from .queries import R, query

# Fixed values of the archive program.
PAGES_PER_ARCHIVE = 100
RECORD_YEAR_OFFSET = 1922.0
RECORD_FEATURES = [1, 2, 3, 4, 5]
RECORD_REG = 1.2
RECORD_MAX_ITER = 20
ALPHA = 0.1


def _page_archives(spark, sf) -> str:
    """Pack ``pages`` into tar.gz files under the shared folder (once)."""
    def write(out):
        pages = fx.table(spark, sf, "pages")
        packed = archive.pack_archives(
            pages.withColumn("g", F.floor(F.col("page_id") / PAGES_PER_ARCHIVE)),
            "g", F.concat(F.col("page_id").cast("string"), F.lit(".html")), "html", prefix="pages")
        archive.write_files(packed, storage.qualify(spark, out))

    return fx.written(spark, "page_archives", fx.input_tag(spark, sf, "pages", PAGES_PER_ARCHIVE), write)


def _members(spark, sf, content: bool = False):
    return archive.read_archives(spark, _page_archives(spark, sf) + "/*.tar.gz", suffix=".html", content=content)


def _page_id():
    return F.regexp_extract("member", r"(\d+)\.html$", 1).cast("bigint").alias("page_id")


@query("archive_members")
def q_archive_members(spark, sf):
    return _members(spark, sf).select(_page_id(), F.col("size"))


@query("archive_content_hash")
def q_archive_content_hash(spark, sf):
    return _members(spark, sf, content=True).select(_page_id(), F.md5("content").alias("md5"))


@query("archive_counts")
def q_archive_counts(spark, sf):
    m = _members(spark, sf).withColumn("archive", F.regexp_extract("path", r"([^/]+)$", 1))
    return m.groupBy("archive").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


#: Decompressed bytes between restart points: small, so that the page archives have several.
SPACING = 1 << 18


def _page_index(spark, sf) -> str:
    """The restart points of the page archives, written once."""
    def write(out):
        paths = [p for p, _ in storage.glob(spark, _page_archives(spark, sf) + "/*.tar.gz")]
        restart.index_archives(spark, paths, SPACING).write.parquet(out)

    return fx.written(spark, "page_restarts", fx.input_tag(spark, sf, "pages", PAGES_PER_ARCHIVE, SPACING), write)


@query("archive_segments_hash")
def q_archive_segments_hash(spark, sf):
    """Members of gzip archives that many tasks read, each from a restart point."""
    index = spark.read.schema(restart.INDEX_SCHEMA).parquet(_page_index(spark, sf))
    return restart.read_indexed(index, ".html").select(_page_id(), F.col("size"), F.md5("content").alias("md5"))


def _flat(spark, sf):
    return records.flatten_records(fx.song_record(spark, sf), keep=["song_id"])


@query("flatten_record")
def q_flatten_record(spark, sf):
    return _flat(spark, sf)


@query("nested_flat")
def q_nested_flat(spark, sf):
    """Every leaf of a nested record as a column, by its schema alone."""
    return records.flatten(fx.deep_record(spark, sf).drop("segments"), keep=["song_id"])


@query("nested_segments")
def q_nested_segments(spark, sf):
    """A row per element of an array of structs, nested structs flattened."""
    return records.unnest(fx.deep_record(spark, sf), "segments", keep=["song_id"], outer=True)


@query("nested_beats")
def q_nested_beats(spark, sf):
    """A row per element of an array inside an array of structs."""
    return records.unnest(fx.deep_record(spark, sf), "segments.beats", keep=["song_id"])


@query("nan_to_zero")
def q_nan_to_zero(spark, sf):
    # one pass over the raw values: NaN counts and sums after NaN -> 0
    raw = records.flatten_records(fx.song_record(spark, sf), nan_zero=False)
    return raw.agg(F.count(F.lit(1)).alias("n"),
                   F.count_if(F.isnan("danceability")).alias("nan_danceability"),
                   F.count_if(F.isnan("artist_latitude")).alias("nan_latitude"),
                   F.round(F.sum(nan_to_zero("danceability")), R).alias("sum_danceability"),
                   F.round(F.sum(nan_to_zero("artist_longitude")), R).alias("sum_longitude"))


@query("known_year")
def q_known_year(spark, sf):
    k = records.known_year(_flat(spark, sf))
    return k.agg(F.count(F.lit(1)).alias("n"), F.sum("year").alias("sum_year"),
                 F.min("year").alias("min_year"))


def _record_model(spark, sf):
    known = records.known_year(_flat(spark, sf))
    vec = records.as_vector(known, keep=["song_id"])
    train_r, test_r = sp.hash_split(vec, ["song_id"], [0.8, 0.2])
    stages = [
        fe.VectorSlicer(inputCol="value", outputCol="year_v", indices=[0]),
        fe.ElementToDouble(inputCol="year_v", outputCol="label"),
        fe.MinShift(inputCol="label", outputCol="label_shifted", offset=RECORD_YEAR_OFFSET),
        fe.VectorSlicer(inputCol="value", outputCol="features", indices=RECORD_FEATURES),
        ElasticNet(featuresCol="features", labelCol="label_shifted", regParam=RECORD_REG,
                   elasticNetParam=ALPHA, maxIter=RECORD_MAX_ITER),
    ]
    pm = Pipeline(stages=stages).fit(train_r)
    return pm, test_r


@query("record_enet_coefficients")
def q_record_enet_coefficients(spark, sf):
    pm, _ = _record_model(spark, sf)
    return pm.stages[-1].terms_frame(spark).select("term", F.round("value", R).alias("value"))


@query("record_enet_test_rmse")
def q_record_enet_test_rmse(spark, sf):
    pm, test_r = _record_model(spark, sf)
    model = pm.stages[-1]
    return model.evaluate(pm.transform(test_r)).select(F.round("rmse", R).alias("rmse"))
