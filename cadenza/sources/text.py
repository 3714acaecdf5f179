"""Line-oriented text source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per line: ``value string`` (splittable for uncompressed and
    bzip2 files, so large files spread across tasks)."""
    return spark.read.text(paths)


def write_lines(df: DataFrame, path: str, value_col: str = "value",
                compression: str | None = None) -> str:
    """Write one string column as text files (overwrite). Returns ``path``."""
    w = df.select(value_col).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path


def materialize_lines(spark: SparkSession, df: DataFrame, path: str,
                      value_col: str = "value") -> str:
    """Write ``df`` as text once; reuse the files when a finished write
    (``_SUCCESS`` marker) is already there. Safe to re-run after a failure:
    an unfinished write has no marker and is overwritten."""
    from .storage import exists
    if not exists(spark, path + "/_SUCCESS"):
        write_lines(df, path, value_col)
    return path
