"""Stand-in inputs derived by Spark from the given parquet tables.

The workloads expect song lines (13 comma-separated numbers, field 0 the
release year), bank lines (``;``-separated, quoted, with a header) and
nested song records. They are derived from ``lineitem`` and ``customer``
with column expressions, so their size grows with the data and Catalyst
prunes unused columns at the scan. The song lines and records are written
once into the shared checkpoint folder (keyed by the input's files, the
derivation code and its constants) and scanned from there, like input files already in storage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the stand-in derivation (shared with the SQL oracles).
YEAR_BASE = 1922
SONG_KEY_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FEATURE_COLS = [f"f{i}" for i in range(1, 13)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """:func:`table` with its rows dealt out where a few tasks would read most
    of them: one task reads a whole row group, however many splits its file has.
    The raw columns are dealt, by a row's place in its file (no sort, no hot
    key), so what is derived from them is derived in all tasks. Evenly read
    inputs pass through unchanged."""
    rows = table(spark, sf_dir, name)
    tasks = max(spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    read = (rows.select(F.spark_partition_id().alias("split")).groupBy("split").count()
                .agg(F.max("count").alias("largest"), F.sum("count").alias("all")).first())
    if not read["all"] or read["largest"] * spark.sparkContext.defaultParallelism <= 2 * read["all"]:
        return rows
    return rows.repartition(tasks, F.col("_metadata.row_index"))


def _mod_feature(a: str, ka: int, b: str, kb: int) -> Column:
    return ((F.col(a) * ka + F.col(b) * kb) % 1000) / F.lit(1000.0)


def _song_exprs() -> dict[str, Column]:
    f = {
        "f1": F.col("l_quantity") / F.lit(50.0),
        "f2": F.col("l_extendedprice") / F.lit(105000.0),
        "f3": F.col("l_discount") * 10,
        "f4": F.col("l_tax") / F.lit(0.08),
        "f5": F.col("l_linenumber") / F.lit(7.0),
        "f6": _mod_feature("l_orderkey", 13, "l_partkey", 17),
        "f7": _mod_feature("l_orderkey", 101, "l_suppkey", 7),
        "f8": _mod_feature("l_partkey", 211, "l_suppkey", 3),
        "f9": _mod_feature("l_orderkey", 307, "l_linenumber", 11),
        "f10": _mod_feature("l_partkey", 401, "l_linenumber", 23),
        "f11": _mod_feature("l_orderkey", 503, "l_partkey", 29),
        "f12": ((F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729
                 + F.col("l_suppkey") * 31) % 1000) / F.lit(1000.0),
    }
    score = F.lit(40) * f["f1"] + F.lit(25) * f["f2"] + F.lit(15) * f["f3"] + F.lit(8) * f["f12"]
    f["year"] = (F.lit(YEAR_BASE) + F.floor(score)).cast("double")
    f["song_id"] = F.concat_ws("-", *[F.col(k).cast("string") for k in SONG_KEY_COLS])
    return f


def song(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    """``song_id string, year double, f1..f12 double`` (one row per lineitem)."""
    f = _song_exprs()
    return read(spark, sf_dir, "lineitem").select(
        *[f[c].alias(c) for c in ["song_id", "year"] + FEATURE_COLS])


def derive_song_lines(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    """``song_id string, value string`` computed from ``lineitem``: each song
    as one CSV line ``year,f1,...,f12`` (doubles in Spark's text form)."""
    s = song(spark, sf_dir, read)
    value = F.concat_ws(",", *[F.col(c).cast("string") for c in ["year"] + FEATURE_COLS])
    return s.select("song_id", value.alias("value"))


def version() -> str:
    """The code and the fixed values that derive tables: the source of the modules
    involved, and the values of this module's constants as they are now."""
    import inspect
    import sys

    from ..functions import parse
    from ..operators import songs
    from ..sources import archive, delimited, text
    here = sys.modules[__name__]
    parts = [inspect.getsource(m) for m in (here, parse, songs, archive, delimited, text)]
    parts += [repr(v) for k, v in sorted(vars(here).items()) if k.isupper()]
    return "\n".join(parts)


def input_tag(spark: SparkSession, sf_dir: str, table_name: str, *more) -> str:
    """Key of a table derived from an input table: the input's files (path,
    length, modification time), :func:`version` and any ``more`` values. New
    whenever the data, the code or a constant changes."""
    import hashlib

    from ..sources import storage
    files = storage.listing(spark, f"{sf_dir.rstrip('/')}/{table_name}.parquet")
    return hashlib.md5(repr((files, version(), more)).encode()).hexdigest()[:16]


def written(spark: SparkSession, name: str, tag: str, write) -> str:
    """The path of a derived table in the shared folder, written on first use."""
    from ..session import checkpoint_root
    from ..sources import storage
    return storage.publish(spark, f"{checkpoint_root(spark)}/cadenza/{name}_{tag}", write)


def _scanned(spark: SparkSession, sf_dir: str, name: str, derive, schema: str, materialize: bool) -> DataFrame:
    """The derived table, written once and scanned; derived on every use where
    there is no shared folder to write it to."""
    from ..session import has_shared_folder
    if not materialize or not has_shared_folder(spark):
        return derive(spark, sf_dir)
    path = written(spark, name, input_tag(spark, sf_dir, "lineitem"),
                   lambda out: derive(spark, sf_dir, spread).write.parquet(out))
    return spark.read.schema(schema).parquet(path)


def song_lines(spark: SparkSession, sf_dir: str, with_id: bool = True,
               materialize: bool = True) -> DataFrame:
    """The song lines as an input table. With ``materialize`` (default) Spark
    writes them once as parquet into the shared checkpoint folder and every
    query scans that table, like a text file of songs already in storage;
    otherwise the lines are derived lazily on every use. The id rides along
    so splits can hash a stable key."""
    df = _scanned(spark, sf_dir, "song_lines", derive_song_lines, "song_id string, value string", materialize)
    return df if with_id else df.select("value")


def flawed_lines(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """The song lines (or ``lines``, rows alike) with bad fields: the year is
    ``n/a`` where the order key is a multiple of 7, the first feature ``x`` where
    the line number is one of 5, and the second is empty where the part key is one of 11."""
    key = F.split("song_id", "-")
    parts = F.split("value", ",", 4)
    bad = lambda i, n: F.get(key, i).cast("long") % n == 0
    lines = song_lines(spark, sf_dir) if lines is None else lines
    return lines.select("song_id", F.concat_ws(
        ",", F.when(bad(0, 7), "n/a").otherwise(F.get(parts, 0)), F.when(bad(1, 5), "x").otherwise(F.get(parts, 1)),
        F.when(bad(2, 11), "").otherwise(F.get(parts, 2)), F.get(parts, 3)).alias("value"))


# Fixed bank layout: the 17 header names of the delimited bank file.
BANK_HEADER = ["age", "job", "marital", "education", "default", "balance", "housing",
               "loan", "contact", "day", "month", "duration", "campaign", "pdays",
               "previous", "poutcome", "y"]


def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def bank_lines(spark: SparkSession, sf_dir: str, header: bool = True) -> DataFrame:
    """``value string`` bank lines derived from ``customer``:
    age = 18 + c_custkey % 60, job = c_mktsegment, balance = int(c_acctbal)
    (truncated), constants elsewhere; the quoted header line comes first."""
    c = table(spark, sf_dir, "customer")
    age = (F.lit(18) + F.col("c_custkey") % 60).cast("string")
    balance = F.col("c_acctbal").cast("int").cast("string")
    fields = [age, _q(F.col("c_mktsegment")), _q(F.lit("married")), _q(F.lit("secondary")),
              _q(F.lit("no")), balance, _q(F.lit("yes")), _q(F.lit("no")),
              _q(F.lit("cellular")), F.lit("5"), _q(F.lit("may")), F.lit("100"),
              F.lit("1"), F.lit("-1"), F.lit("0"), _q(F.lit("unknown")), _q(F.lit("no"))]
    rows = c.select(F.concat_ws(";", *fields).alias("value"))
    if not header:
        return rows
    # The header is tied to a column so the optimizer cannot constant-fold a
    # parse of it before the header filter has removed it.
    head_text = F.lit(";".join(f'"{h}"' for h in BANK_HEADER))
    head = spark.range(1).select(
        F.when(F.col("id") >= 0, head_text).alias("value"))
    return head.unionByName(rows)


def song_record(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """Nested song records as an input table (written once as parquet into the
    shared folder and scanned from there, like :func:`song_lines`; nested
    fields are pruned at the scan). See :func:`derive_song_record`."""
    return _scanned(spark, sf_dir, "song_record", derive_song_record, RECORD_SCHEMA, materialize)


# The nested layout of a song record.
RECORD_SCHEMA = (
    "song_id string, musicbrainz struct<year: int>, analysis struct<danceability: double, duration: double, "
    "end_of_fade_in: double, energy: double, key_confidence: double, loudness: double, mode_confidence: double, "
    "start_of_fade_out: double, tempo: double, time_signature_confidence: double>, "
    "metadata struct<artist_familiarity: double, artist_hotttnesss: double, artist_latitude: double, "
    "artist_longitude: double, song_hotttnesss: double>")


def derive_song_record(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    """Nested song records: ``song_id``, ``musicbrainz struct<year int>``,
    ``analysis struct<10 doubles>``, ``metadata struct<5 doubles>``.

    NaN appears in danceability, artist_latitude and artist_longitude where
    ``l_orderkey % 11 = 0``; year is 0 (unknown) where ``l_partkey % 13 = 0``.
    """
    f = _song_exprs()
    s = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", *[f[c].alias(c) for c in ["song_id", "year"] + FEATURE_COLS])
    nan_mask = (F.col("l_orderkey") % 11) == 0
    nan = F.lit(float("nan"))

    def maybe_nan(c: str) -> Column:
        return F.when(nan_mask, nan).otherwise(F.col(c))

    year = F.when(F.col("l_partkey") % 13 == 0, F.lit(0)).otherwise(F.col("year").cast("int"))
    return s.select(
        "song_id",
        F.struct(year.alias("year")).alias("musicbrainz"),
        F.struct(
            maybe_nan("f1").alias("danceability"),
            F.col("f2").alias("duration"),
            F.col("f3").alias("end_of_fade_in"),
            F.col("f4").alias("energy"),
            F.col("f5").alias("key_confidence"),
            F.col("f6").alias("loudness"),
            F.col("f7").alias("mode_confidence"),
            F.col("f8").alias("start_of_fade_out"),
            F.col("f9").alias("tempo"),
            F.col("f10").alias("time_signature_confidence"),
        ).alias("analysis"),
        F.struct(
            F.col("f11").alias("artist_familiarity"),
            F.col("f12").alias("artist_hotttnesss"),
            maybe_nan("f4").alias("artist_latitude"),
            maybe_nan("f5").alias("artist_longitude"),
            F.col("f6").alias("song_hotttnesss"),
        ).alias("metadata"),
    )


def deep_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`song_record` with an array of structs added: ``segments`` has as many
    elements as the line number modulo 4 (a null array where the order key is a
    multiple of 9), each a start, a nested pitch and an array of beats, as many as
    the element's number less one."""
    key = F.split("song_id", "-")
    n = (F.element_at(key, 2).cast("int") % 4).cast("int")
    numbers = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))

    def segment(i: Column) -> Column:
        beats = F.transform(F.sequence(F.lit(1), i), lambda k: k * F.col("analysis.duration"))
        return F.struct(
            (i * F.col("analysis.end_of_fade_in")).alias("start"),
            F.struct((i * F.col("analysis.energy")).alias("low"),
                     F.struct((i + F.col("analysis.duration")).alias("value")).alias("high")).alias("pitch"),
            F.slice(beats, 1, i - 1).alias("beats"))
    segments = F.when(F.element_at(key, 1).cast("long") % 9 != 0, F.transform(numbers, segment))
    return song_record(spark, sf_dir).withColumn("segments", segments)
