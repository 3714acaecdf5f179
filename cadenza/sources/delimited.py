"""Delimited (``;``-separated, quoted) records such as the bank file.

Two entry points with the same result: :func:`read_delimited` for files
(Spark's CSV reader) and :func:`parse_delimited` for a column of lines
(``from_csv``, a JVM expression). Both honour quotes, so a delimiter inside
a quoted field does not split it, and ``""`` inside quotes is one quote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed layout of the bank record: all 17 fields, in file order.
BANK_FIELDS = [
    ("age", T.IntegerType()), ("job", T.StringType()), ("marital", T.StringType()),
    ("education", T.StringType()), ("default", T.StringType()), ("balance", T.IntegerType()),
    ("housing", T.StringType()), ("loan", T.StringType()), ("contact", T.StringType()),
    ("day", T.IntegerType()), ("month", T.StringType()), ("duration", T.IntegerType()),
    ("campaign", T.IntegerType()), ("pdays", T.IntegerType()), ("previous", T.IntegerType()),
    ("poutcome", T.StringType()), ("y", T.StringType()),
]
BANK_FILE_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in BANK_FIELDS])
# The typed bank row keeps fields 0, 1, 2, 3 and 5.
BANK_COLUMNS = ["age", "job", "marital", "education", "balance"]

_CSV_OPTS = {"sep": ";", "quote": '"', "escape": '"', "mode": "FAILFAST"}


def read_delimited(spark: SparkSession, paths: str | list[str],
                   schema: T.StructType = BANK_FILE_SCHEMA, header: bool = True,
                   sep: str = ";", columns: list[str] | None = BANK_COLUMNS) -> DataFrame:
    """Read delimited files with a declared schema (no inference pass)."""
    opts = dict(_CSV_OPTS, sep=sep)
    df = spark.read.options(**opts).csv(paths, schema=schema, header=header)
    return df.select(*columns) if columns else df


def write_delimited(df: DataFrame, path: str, sep: str = ";", quote_all: bool = True) -> str:
    """Write delimited files with a header line in every part file (so each
    file reads back on its own), quoting like the source format."""
    (df.write.mode("overwrite")
       .options(sep=sep, header=True, quote='"', escape='"', quoteAll=quote_all)
       .csv(path))
    return path


def parse_delimited(lines: DataFrame, schema: T.StructType = BANK_FILE_SCHEMA,
                    value_col: str = "value", sep: str = ";",
                    header_first_field: str | None = "age",
                    columns: list[str] | None = BANK_COLUMNS) -> DataFrame:
    """Parse a ``value`` column of delimited lines.

    A header line (first field equal to ``header_first_field`` once quotes
    are removed) is dropped wherever it occurs, so several concatenated files
    each with a header are fine.
    """
    opts = dict(_CSV_OPTS, sep=sep)
    df = lines
    if header_first_field is not None:
        first = F.regexp_replace(F.substring_index(F.col(value_col), sep, 1), '"', "")
        df = df.filter(first != F.lit(header_first_field))
    rec = F.from_csv(F.col(value_col), schema.simpleString(), opts).alias("_r")
    out = df.select(rec).select("_r.*")
    return out.select(*columns) if columns else out
