"""Shared helpers: table access, document keys, packed numpy exchanges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A null doc_id sorts after every other id where documents are ordered.
LAST_ID = 2**63 - 1

#: ASCII white space, as every contract of this subpackage spells it.
WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Input bytes for which an explicit exchange has a partition.
PART_BYTES = 16 << 20


def partitions(df: DataFrame) -> int:
    """Partitions of an explicit exchange of what ``df`` holds: the session's
    shuffle setting, more where the input is large, so that a task's share does
    not grow with it. An input of unknown size takes the setting."""
    setting = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = sum(int(leaf.stats().sizeInBytes()) for leaf in _leaves(df._jdf.queryExecution().optimizedPlan()))
    return max(setting, -(-known // PART_BYTES)) if known < 1 << 60 else setting


def _leaves(plan):
    found = plan.collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def body(text: Column) -> Column:
    """The text of a document; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def sub_hash(text: Column, seed: int) -> Column:
    """64 bits of a text under a seed."""
    return F.xxhash64(text, F.lit(seed))


@dataclass
class Named:
    """Documents whose rows have names.

    ``rows`` has ``doc_id, id, sub, text`` (and ``rest``) for every row: ``id`` is
    the doc_id (null: ``LAST_ID``), and two rows have the same (id, sub) only if
    their ids and texts are equal. ``unique`` has one row per name. Where ids
    repeat, ``copies`` says how many rows each name has; else it is None, as
    every name is one row's.
    """

    rows: DataFrame
    unique: DataFrame
    copies: DataFrame | None


def named(docs: DataFrame, carry: bool = False, sub=sub_hash) -> Named:
    """Name the rows of ``docs``; with ``carry``, a struct ``rest`` of all the other
    columns is kept. Where no id repeats, the id alone is the name. Else ``sub``
    is a hash of the text under the first seed that separates all texts of each
    id, which is checked against their SHA-256.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] if carry else []
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(LAST_ID)).alias("id"),
                        body(F.col("text")).alias("text"), *([F.struct(*rest).alias("rest")] if rest else []))
    columns = ["doc_id", "id", "sub", "text"] + (["rest"] if rest else [])
    if texts.groupBy("id").count().where("count > 1").isEmpty():
        rows = texts.withColumn("sub", F.lit(0).cast("long")).select(columns)
        return Named(rows, rows.drop("rest"), None)
    checkpoint_ready(docs.sparkSession)
    seed = 0
    while True:
        rows = texts.withColumn("sub", sub(F.col("text"), seed)).select(columns)
        sha = F.sha2("text", 256)
        names = (rows.groupBy("id", "sub").agg(F.count("*").alias("copies"), F.min(sha).alias("low"), F.max(sha).alias("high"))
                 .checkpoint())
        if names.where("low <> high").isEmpty():
            break
        seed += 1
    return Named(rows, rows.drop("rest").dropDuplicates(["id", "sub"]), names.select("id", "sub", "copies"))


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not use."""
    while name.lower() in (c.lower() for c in docs.columns):
        name = f"_{name}"
    return name


def checkpoint_ready(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` use the folder of spark.checkpoint.dir."""
    from cadenza.session import checkpoint_root
    checkpoint_root(spark)


def with_lists(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Rows with names joined with one row of lists per name. The lists are the
    build side, so the texts are never sorted, and two joins of the same ``docs``
    share one shuffle of them."""
    return docs.join(lists.hint("shuffle_hash"), ["id", "sub"], how)


#: Rows of one name that meet its lists in one task.
SAME = 1000


def spread_lists(texts: Named, lists: DataFrame) -> DataFrame:
    """All rows of ``texts`` left-joined with their lists; a name that very many
    rows share is salted, so they do not meet in one task."""
    if texts.copies is None:
        return with_lists(texts.rows, lists, "left")
    hot = texts.copies.where(F.col("copies") > SAME)
    salts = F.ceil(F.col("copies") / SAME).cast("int")
    hot = hot.join(lists, ["id", "sub"]).withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    hot = hot.withColumn("salts", salts).checkpoint()
    if hot.isEmpty():
        return with_lists(texts.rows, lists, "left")
    # one row per hot name with lists: where there are many such names, rows find them by a shuffle
    keys = hot.where("salt = 0").select("id", "sub", "salts")
    salted = texts.rows.join(keys, ["id", "sub"], "left").withColumn(
        "salt", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("salts")).cast("int"), F.lit(0))).drop("salts")
    cold = lists.join(keys.select("id", "sub"), ["id", "sub"], "left_anti").withColumn("salt", F.lit(0))
    both = cold.unionByName(hot.drop("copies", "salts"))
    return salted.join(both.hint("shuffle_hash"), ["id", "sub", "salt"], "left").drop("salt")


def text_chunks(batches, limit: int = 2 << 20, column: str = "text"):
    """Slices of Arrow batches with about ``limit`` bytes of text, a row at least."""
    import pyarrow.compute as pc
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            size = size or 0
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if len(sizes) > start:
            yield batch.slice(start)


def as_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column without nulls."""
    import pyarrow as pa
    return column.cast(pa.binary()).to_pylist()


def worker_held(key: str, make):
    """What ``make`` gives, made once in a Python worker and kept for its later tasks."""
    import sys
    import types
    held = sys.modules.setdefault("_cadenza_worker", types.ModuleType("_cadenza_worker"))
    if getattr(held, "key", None) != key:
        held.key, held.value = key, make()
    return held.value
