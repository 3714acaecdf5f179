"""Length-bucketed packing: optimal bucket boundaries, token-budget batches.

1. The global histogram of lengths, aggregated by Spark. Lengths are rounded up
   to cells: exact up to ``exact_to``, then ``cells`` of them per doubling, so the
   histogram has a fixed bound of cells however large the corpus is. A cell counts
   as the largest length in it.
2. Dynamic programming over the cells chooses at most ``n_buckets`` boundaries
   that minimise the padding summed over all documents. It is exact for lengths up
   to ``exact_to``, and beyond for boundaries that are the largest length of a cell;
   against any boundaries a document loses less than 1/``cells`` of its bucket's length.
3. Each bucket is cut into shards of about ``shard_rows`` by a hash of the row and of
   its place in the input, so that equal rows spread too, and each shard into batches of ``token_budget // boundary`` documents (one at least),
   so a hot bucket spreads over many tasks.

A token is a word ``[^\\x20\\x09-\\x0D]+``, or what ``length_col`` counts.
Defined cases: a null or empty text has length 0 and goes to the first bucket,
a null length counts as 0, repeated rows are packed one by one, a document
longer than the budget has a batch of its own, an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.llm.common import WHITE, body, table

N_BUCKETS, TOKEN_BUDGET, SHARD_ROWS = 16, 65_536, 4_096
EXACT_TO, CELLS = 256, 64


def words(text: Column) -> Column:
    """Number of words of a text, counted in the JVM."""
    parts = F.split(body(text), WHITE)
    return F.size(F.filter(parts, lambda p: p != "")).cast("long")


def cell(length: Column, exact_to: int = EXACT_TO, cells: int = CELLS) -> Column:
    """The upper end of a length's histogram cell."""
    top = F.greatest(length, F.lit(exact_to + 1)).cast("double")
    step = F.greatest(F.pow(F.lit(2.0), F.floor(F.log2(top - 1))) / cells, F.lit(1.0))
    return F.when(length <= exact_to, length).otherwise(
        (F.ceil(length / step) * step).cast("long"))


def boundaries(lengths: np.ndarray, counts: np.ndarray, k: int) -> list[int]:
    """At most ``k`` values of sorted distinct ``lengths``, the largest included,
    so that padding each document up to the next one costs least in total."""
    n = len(lengths)
    if n == 0:
        return []
    k = min(k, n)
    c = np.concatenate([[0], np.cumsum(counts, dtype=np.float64)])
    # cost of a bucket of cells i..j-1 is lengths[j-1] * count - tokens; tokens are constant
    best = np.concatenate([[0.0], np.full(n, np.inf)])
    cuts = []
    for _ in range(k):
        new, arg = best.copy(), np.full(n + 1, -1)
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (c[j] - c[:j])
            i = int(np.argmin(cost))
            if cost[i] < new[j]:
                new[j], arg[j] = cost[i], i
        cuts.append(arg)
        best = new
    out, j, b = [], n, k - 1
    while j > 0:
        i = cuts[b][j]
        if i >= 0:
            out.append(int(lengths[j - 1]))
            j = i
        b -= 1
    return out[::-1]


def pack(docs: DataFrame, n_buckets: int = N_BUCKETS, token_budget: int = TOKEN_BUDGET,
         shard_rows: int = SHARD_ROWS, length_col: str | None = None,
         exact_to: int = 4 * EXACT_TO, cells: int = 4 * CELLS) -> DataFrame:
    """``doc_id, n_tokens, bucket, bucket_tokens, batch, slot``: ``bucket_tokens``
    is the padded length, ``batch`` names a batch of the bucket, ``slot`` the
    document's place in it."""
    if n_buckets < 1 or token_budget < 1 or shard_rows < 1:
        raise ValueError("n_buckets, token_budget and shard_rows must be positive")
    length = (F.coalesce(F.col(length_col).cast("long"), F.lit(0)) if length_col
              else words(F.col("text")))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), length.alias("n_tokens"),
                        F.xxhash64("doc_id", body(F.col("text"))).alias("spread"))
    hist = sorted((r["top"], r["n"]) for r in
                  sized.groupBy(cell(F.col("n_tokens"), exact_to, cells).alias("cell"))
                  .agg(F.max("n_tokens").alias("top"), F.count("*").alias("n")).collect())
    at = np.array([h[0] for h in hist], dtype=np.int64)
    n = np.array([h[1] for h in hist], dtype=np.int64)
    ends = boundaries(at, n, n_buckets) or [0]
    held = np.bincount(np.searchsorted(ends, at), weights=n, minlength=len(ends))
    bucket = F.lit(len(ends) - 1)
    for i in range(len(ends) - 2, -1, -1):
        bucket = F.when(F.col("n_tokens") <= ends[i], F.lit(i)).otherwise(bucket)
    per_bucket = F.array(*[
        F.struct(F.lit(e).cast("long").alias("tokens"),
                 F.lit(max(1, token_budget // max(1, e))).alias("slots"),
                 F.lit(int(-(-h // shard_rows)) or 1).alias("shards"))
        for e, h in zip(ends, held, strict=True)])
    placed = sized.withColumn("bucket", bucket.cast("int"))
    placed = placed.withColumn("b", F.element_at(per_bucket, F.col("bucket") + 1))
    salt = F.xxhash64("spread", F.monotonically_increasing_id())
    placed = placed.withColumn("shard", F.pmod(salt, F.col("b.shards").cast("long")))
    order = W.partitionBy("bucket", "shard").orderBy("n_tokens", "doc_id", "spread")
    row = F.row_number().over(order) - 1
    return placed.withColumn("row", row).select(
        "doc_id", "n_tokens", "bucket", F.col("b.tokens").alias("bucket_tokens"),
        F.concat_ws("-", "bucket", "shard",
                    F.floor(F.col("row") / F.col("b.slots")).cast("long")).alias("batch"),
        F.pmod(F.col("row"), F.col("b.slots")).cast("int").alias("slot"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
