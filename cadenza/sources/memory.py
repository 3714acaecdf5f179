"""In-memory rows from the driver (small, fixed inputs such as unit fixtures)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """Rows (tuples/dicts) with an explicit schema; no inference."""
    return spark.createDataFrame(list(rows), schema=schema)


def from_lines(spark: SparkSession, lines: Iterable[str]) -> DataFrame:
    """A ``value string`` frame from driver-side strings."""
    schema = T.StructType([T.StructField("value", T.StringType(), True)])
    return spark.createDataFrame([(s,) for s in lines], schema=schema)
