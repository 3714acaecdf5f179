"""The corpus pipeline: filter, deduplicate and pack the documents.

Each stage calls one operator of ``cadenza.llm`` on all its predecessor kept;
its result is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import exact_dedup, packing, simhash, substring_dedup, toxicity
from cadenza.llm.common import table
from cadenza.session import checkpoint_root
from cadenza.sources import storage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.without_near_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack_batches),
]

#: A trained model and chained near-duplicates are not SQL; the tests compare
#: the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. They run when this is called; each one's table
    goes to a folder ``pipeline-<id>`` of its own in the shared folder. A failed
    run removes it. After a run the result reads its last table, so the folder is
    the caller's to remove, with the rest of ``spark.checkpoint.dir``.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    try:
        for i, (name, stage) in enumerate(STAGES):
            path = f"{folder}/{i}-{name}"
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    except BaseException:
        storage.remove(spark, folder)
        raise
    return docs
