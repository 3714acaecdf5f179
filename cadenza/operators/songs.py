"""Typed song rows from delimited lines (split -> cast), all JVM-side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import field, split_fields, to_double, to_int_truncated

# Row type of a typed song: nullable int year plus the first three features.
SONG_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType(), True),
    T.StructField("f1", T.DoubleType(), True),
    T.StructField("f2", T.DoubleType(), True),
    T.StructField("f3", T.DoubleType(), True),
])


def parse_songs(lines: DataFrame, n_features: int = 3, value_col: str = "value",
                sep: str = ",", strict: bool = True, keep: list[str] | None = None) -> DataFrame:
    """``value`` lines -> ``year int, f1..fn double``.

    The year arrives as a double string and is truncated toward zero.
    ``strict=False`` turns unparseable fields into nulls instead of failing.
    Columns named in ``keep`` (e.g. a row id) are carried through.
    """
    keep = keep if keep is not None else [c for c in lines.columns if c != value_col]
    toks = split_fields(value_col, sep, n_features + 1)
    cols = [to_int_truncated(field(toks, 0), strict).alias("year")]
    cols += [to_double(field(toks, i), strict).alias(f"f{i}") for i in range(1, n_features + 1)]
    return lines.select(*keep, *cols)


def field_count(lines: DataFrame, value_col: str = "value", sep: str = ",") -> DataFrame:
    """Number of fields per line plus the parsed label (field 0)."""
    toks = split_fields(value_col, sep)
    keep = [c for c in lines.columns if c != value_col]
    return lines.select(*keep, F.size(toks).alias("n_fields"),
                        to_double(field(toks, 0)).alias("label"))


def reject_counts(lines: DataFrame, n_features: int = 3, value_col: str = "value", sep: str = ",") -> DataFrame:
    """One row: ``n`` lines, ``rejected`` lines with a bad field, and per column
    the fields that are there but do not parse (``strict=False`` gives nulls
    for them). An empty or missing field is a missing value and not bad."""
    toks = split_fields(value_col, sep, n_features + 1)
    names = ["year"] + [f"f{i}" for i in range(1, n_features + 1)]
    bad = [(field(toks, i) != "") & to_double(field(toks, i), strict=False).isNull() for i in range(len(names))]
    bad = [F.coalesce(b, F.lit(False)) for b in bad]
    some = bad[0]
    for b in bad[1:]:
        some = some | b
    return lines.agg(F.count(F.lit(1)).alias("n"), F.count_if(some).alias("rejected"),
                     *[F.count_if(b).alias(f"bad_{name}") for b, name in zip(bad, names)])


def parse_checked(lines: DataFrame, n_features: int = 3, value_col: str = "value", sep: str = ",") -> DataFrame:
    """One parse that tells good lines from bad ones: all other columns, ``accepted``,
    the typed columns (null in a rejected line), ``rejected_line`` (null in an
    accepted one) and ``reasons``, one text per bad field. A field that is there but
    does not parse is bad, as is a year beyond an int; a missing one is null."""
    toks = split_fields(value_col, sep, n_features + 1)
    names = ["year"] + [f"f{i}" for i in range(1, n_features + 1)]
    # array_remove is compiled; array_compact is not, and a projection with it splits
    # the line and parses its fields anew wherever they are named
    reasons = []
    for i, name in enumerate(names):
        text, number = field(toks, i), to_double(field(toks, i), strict=False)
        why = F.when((text != "") & number.isNull(), F.lit(f"{name} is not a number"))
        if i == 0:
            why = why.when(number.isNotNull() & to_int_truncated(text, strict=False).isNull(), F.lit("year is out of range"))
        reasons.append(F.coalesce(why, F.lit("")))
    others = [F.col(f"`{c}`") for c in lines.columns if c != value_col]
    parsed = lines.select(*others, F.col(value_col).alias("rejected_line"), F.array_remove(F.array(*reasons), "").alias("reasons"),
                          to_int_truncated(field(toks, 0), strict=False).alias("year"),
                          *(to_double(field(toks, i), strict=False).alias(n) for i, n in enumerate(names) if i))
    good = F.size("reasons") == 0
    return parsed.select(*others, good.alias("accepted"), *(F.when(good, F.col(n)).alias(n) for n in names),
                         F.when(~good, F.col("rejected_line")).alias("rejected_line"), "reasons")


def land_checked(lines: DataFrame, path: str, n_features: int = 3, value_col: str = "value") -> str:
    """Write typed songs and rejected lines from one scan and one parse: one table,
    partitioned by ``accepted``, so each reader below prunes the other half. A task
    keeps a file open for each half; unless the session says otherwise, nothing is sorted."""
    conf, writers = lines.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    unset = conf.get(writers) == "0"
    if unset:
        conf.set(writers, "4")  # at the full number the writer goes over to sorting
    try:
        parse_checked(lines, n_features, value_col).write.mode("overwrite").partitionBy("accepted").parquet(path)
    finally:
        if unset:
            conf.unset(writers)
    return path


def accepted_songs(spark: SparkSession, path: str) -> DataFrame:
    """The typed songs of :func:`land_checked`."""
    return _landed(spark, path).where(F.col("accepted")).drop("accepted", "rejected_line", "reasons")


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """The rejected lines of :func:`land_checked`, as they were, with their reasons."""
    rows = _landed(spark, path).where(~F.col("accepted"))
    return rows.select(*(c for c in rows.columns if c != "accepted" and c != "year" and not c.startswith("f")))


def _landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("accepted", F.col("accepted").cast("boolean"))


def land(songs: DataFrame, path: str, partition_col: str = "year",
         max_records_per_file: int = 5_000_000) -> str:
    """Write typed songs as parquet partitioned by ``partition_col`` so later
    range filters on it prune whole directories (``PartitionFilters``) and
    the text is parsed once.

    The rows are rebalanced by ``partition_col`` first (a ``REBALANCE``
    hint): one shuffle after which adaptive execution splits a hot year
    (say a third of all rows) over several tasks and merges small ones, so
    each year gets a few files of the advisory size instead of one file per
    input task and year. ``max_records_per_file`` caps file size."""
    (songs.hint("rebalance", partition_col)
          .write.mode("overwrite")
          .option("maxRecordsPerFile", max_records_per_file)
          .partitionBy(partition_col).parquet(path))
    return path
