"""Exact dedup by content-defined chunk recipes. DataFrame functions only.

A text is normalised (each run of ASCII white space becomes one space) and cut
into content-defined chunks: a chunk ends at the first place, at least
``MIN_CHUNK`` characters in, where the last characters match ``CUT``, or at
``MAX_CHUNK``. The cut depends on the text alone, so equal texts are cut alike.

1. Each document becomes a recipe: the ordered list of its chunks' 64-bit keys.
2. The distinct chunks travel once, pre-aggregated per map task, and show which
   keys stand for more than one text. Such a key gets an ordinal per text, so a
   (key, ordinal) pair is a verified identifier: one pair, one text.
3. Documents are compared by their lists of identifiers; whole texts never move.

Defined cases: a null text is the empty text (an empty recipe), a null doc_id
stays only if its whole group has none, repeated rows count one by one in
``group_size`` and share one verdict, empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.llm.common import WHITE, body, checkpoint_ready, free_name, table

MIN_CHUNK, MAX_CHUNK = 256, 4096
#: A cut follows two letters of these classes and a blank: about one word in ten.
CUT = "[aeiou][nrst] "


def normalised(text: Column) -> Column:
    return F.regexp_replace(body(text), WHITE, " ")


def chunks(text: Column, low: int = MIN_CHUNK, high: int = MAX_CHUNK) -> Column:
    """The chunks of a text, in order; joined they give the text again."""
    pattern = f"(?s).{{{low},{high - 3}}}?{CUT}|.{{1,{high}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_key(chunk: Column, bits: int) -> Column:
    key = F.xxhash64(chunk)
    return key if bits == 64 else F.shiftrightunsigned(key, 64 - bits)


def exact_dedup(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, n_chunks``, a row per row of ``docs``.

    ``key_bits`` narrows the chunk keys (tests use it to force collisions).
    """
    spark = docs.sparkSession
    checkpoint_ready(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        normalised(F.col("text")).alias("norm"))
    cut = texts.select("doc_id", F.sha2("norm", 256).alias("text_sha256"),
                       chunks(F.col("norm")).alias("chunks"))
    recipes = cut.select("doc_id", "text_sha256",
                         F.transform("chunks", lambda c: chunk_key(c, key_bits)).alias("recipe"))

    pieces = cut.select(F.explode("chunks").alias("chunk"))
    pieces = pieces.select(chunk_key(F.col("chunk"), key_bits).alias("key"), "chunk")
    lexicon = pieces.groupBy("key", "chunk").agg(F.count("*").alias("uses"))
    shared = (lexicon.groupBy("key").agg(F.count("*").alias("n_texts"))
              .where("n_texts > 1").select("key").checkpoint())
    if not shared.isEmpty():
        recipes = _disambiguated(recipes, cut, lexicon, shared, key_bits)
    else:
        recipes = recipes.withColumn("ordinals", F.lit(None).cast("array<int>"))

    same = ["recipe", "ordinals"]
    groups = recipes.groupBy(*same).agg(F.min("doc_id").alias("keep_id"),
                                        F.count("*").alias("group_size"))
    r, g = recipes.alias("r"), groups.alias("g")
    return r.join(g, (F.col("r.recipe") == F.col("g.recipe"))
                  & F.col("r.ordinals").eqNullSafe(F.col("g.ordinals"))).select(
        "r.doc_id", "g.keep_id", "g.group_size",
        F.col("r.doc_id").eqNullSafe(F.col("g.keep_id")).alias("kept"),
        "r.text_sha256", F.size("r.recipe").alias("n_chunks"))


def _disambiguated(recipes: DataFrame, cut: DataFrame, lexicon: DataFrame,
                   shared: DataFrame, key_bits: int) -> DataFrame:
    """Recipes with, per document, the ordinals of chunks whose key is shared.

    Only chunks with a shared key move here. Rows are told apart by
    (doc_id, text_sha256), which is one text.
    """
    ordinals = (lexicon.join(shared, "key").select(
        "key", "chunk", F.row_number().over(W.partitionBy("key").orderBy("chunk")).alias("ord")))
    uses = (cut.select("doc_id", "text_sha256", F.posexplode("chunks").alias("pos", "chunk"))
            .withColumn("key", chunk_key(F.col("chunk"), key_bits))
            .dropDuplicates(["doc_id", "text_sha256", "pos"])
            .join(ordinals, ["key", "chunk"]))
    lists = uses.groupBy("doc_id", "text_sha256").agg(
        F.sort_array(F.collect_list(F.struct("pos", "ord"))).alias("marks"))
    lists = lists.select(F.col("doc_id").alias("m_id"), F.col("text_sha256").alias("m_sha"),
                         F.transform("marks", lambda m: m["ord"]).alias("ordinals"))
    return recipes.join(lists, recipes["doc_id"].eqNullSafe(lists["m_id"])
                        & (recipes["text_sha256"] == lists["m_sha"]), "left").drop("m_id", "m_sha")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay; of repeated rows one."""
    k_id, k_sha = free_name(docs, "k_id"), free_name(docs, "k_sha")
    kept = (exact_dedup(docs).where("kept").groupBy(F.col("doc_id").alias(k_id), F.col("text_sha256").alias(k_sha))
            .agg(F.count("*").alias("uses")).checkpoint())
    sha = F.sha2(normalised(F.col("text")), 256)
    out = docs.join(kept.drop("uses").hint("shuffle_hash"), F.col("doc_id").cast("long").eqNullSafe(F.col(k_id))
                    & (sha == F.col(k_sha)), "left_semi")
    # rows that repeat an id and a normalised text are rare: only then do whole rows move again
    if kept.where("uses > 1").isEmpty():
        return out
    name = free_name(docs, "text_sha256")
    return out.withColumn(name, sha).dropDuplicates(["doc_id", name]).drop(name)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("n_chunks")


ORACLE_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""
