"""SimHash near-dedup with pigeonhole blocks.

1. Fingerprints: ASCII lower case, words ``[^\\x20\\x09-\\x0D]+``, word shingles
   (repeats included) hashed by XXH64; a bit is set if over half the hashes set it.
2. The distinct fingerprints are split into ``BLOCKS`` blocks of bits. Two that
   differ in at most ``max_bits`` places agree in ``BLOCKS - max_bits`` blocks at
   least, so each is listed under every choice of that many blocks and candidates
   share a list. With 6 blocks and 3 bits a list's key has about 32 bits.
3. Lists are cut into tiles of bounded size; a list of n members makes pairs of
   parts, so a hot one spreads over many tasks. A tile verifies Hamming distances
   and emits a star per group it finds, never all its pairs.
4. Groups are the connected components of the links.

Defined cases: null and empty texts and texts of white space only have
fingerprint zero, which links like any other; a text shorter than a shingle is
one shingle; null ids take part and give a null component only if no member has
an id; repeated rows share a fingerprint; an empty table gives no rows.
Of each group ``without_near_copies`` keeps one row, also where ids are null or
repeat: the least by (id with null last, SHA-256 of the text).
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import as_bytes, body, checkpoint_ready, free_name, table, text_chunks
from cadenza.llm.graph import components
from cadenza.llm.tiles import runs, stars

SHINGLE, MAX_BITS, SEED, BLOCKS = 3, 3, 42, 6
#: Members of a part of a list; a tile compares two parts.
PART = 512


def text_hashes(text: bytes, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of each word shingle of a text."""
    from xxhash import xxh64_intdigest
    words = text.lower().split()
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(b" ".join(words), seed)] if words else [], dtype=np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = (starts + sizes)[shingle - 1:].tolist()
    parts = [joined[s:e] for s, e in zip(starts.tolist(), ends, strict=False)]
    return np.fromiter(map(xxh64_intdigest, parts, repeat(seed)), np.uint64, len(parts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that over half the hashes set, as a signed 64-bit integer."""
    counts = np.zeros(64, dtype=np.int64)
    for s in range(0, len(hashes), 1 << 16):
        rows = hashes[s:s + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def text_sha(docs: DataFrame) -> Column:
    """With the id, names a row up to repeated rows."""
    return F.unhex(F.sha2(body(docs["text"]), 256))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, sha: bool = False) -> DataFrame:
    """``doc_id, fp`` (long) for every row; with ``sha``, its ``text_sha`` too."""
    def run(batches):
        import pyarrow as pa
        for chunk in text_chunks(batches):
            fps = [fingerprint(text_hashes(t, shingle, seed)) for t in as_bytes(chunk.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(fps, pa.int64())] + ([chunk.column("sha")] if sha else []),
                names=["doc_id", "fp"] + (["sha"] if sha else []))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body(F.col("text")).alias("text"),
                        *([text_sha(docs).alias("sha")] if sha else []))
    return texts.mapInArrow(run, "doc_id long, fp long" + (", sha binary" if sha else ""))


def block_keys(fp: Column, max_bits: int, blocks: int) -> list[Column]:
    """One key per choice of ``blocks - max_bits`` blocks: the choice and its bits."""
    if not 0 <= max_bits < blocks:
        raise ValueError("max_bits must be less than the number of blocks")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:], strict=False)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = []
    for i, choice in enumerate(combinations(range(blocks), blocks - max_bits)):
        mask = signed(sum(masks[c] for c in choice))
        keys.append(F.struct(F.lit(i).alias("table"), fp.bitwiseAND(F.lit(mask)).alias("bits")))
    return keys


def links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, part: int = PART) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) whose
    components are those of all links."""
    listed = fps.select("fp", F.explode(F.array(*block_keys(F.col("fp"), max_bits, blocks))).alias("k"))
    listed = listed.select("fp", "k.table", "k.bits")
    counts = listed.groupBy("table", "bits").agg(F.count("*").alias("n")).where("n > 1")
    tiled = listed.join(counts, ["table", "bits"])
    tiled = tiled.withColumn("parts", F.ceil(F.col("n") / part).cast("int"))
    tiled = tiled.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    tiled = tiled.select("fp", "table", "bits", "own",
                         F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    tiled = tiled.select("fp", "table", "bits", F.least("own", "other").alias("i"),
                         F.greatest("own", "other").alias("j"))
    keys = ["table", "bits", "i", "j"]

    def run(batches):
        import pyarrow as pa
        for batch, starts, ends in runs(batches, keys):
            fp = batch.column("fp").to_numpy()
            sizes = ends - starts
            two = starts[sizes == 2]
            near = np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= max_bits
            a, b = [fp[two[near]]], [fp[two[near] + 1]]
            for s, e in zip(starts[sizes > 2], ends[sizes > 2], strict=True):
                x = fp[s:e].view(np.uint64)
                close = np.bitwise_count(x[:, None] ^ x[None, :]) <= max_bits
                root, leaf = stars(fp[s:e], close)
                a.append(root)
                b.append(leaf)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))],
                                             names=["a", "b"])

    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (tiled.repartition(n, *keys).sortWithinPartitions(*keys, "fp")
            .mapInArrow(run, "a long, b long"))


def rooted(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, least, root``: the distinct fingerprints with a name of their group."""
    groups = components(links(distinct, max_bits))
    return distinct.join(groups, distinct["fp"] == groups["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                  seed: int = SEED) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row."""
    checkpoint_ready(docs.sparkSession)
    marked = fingerprints(docs, shingle, seed).checkpoint()
    named = rooted(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), max_bits)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    names = named.join(least, "root").select("fp", "component_id")
    return marked.join(names, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs``, all columns, of each group."""
    checkpoint_ready(docs.sparkSession)
    marked = fingerprints(docs, sha=True).checkpoint()
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sha")
    named = rooted(marked.groupBy("fp").agg(F.min(row).alias("least")))
    k_id, k_sha = free_name(docs, "k_id"), free_name(docs, "k_sha")
    kept = named.groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.doc_id").alias(k_id), F.col("least.sha").alias(k_sha))
    out = docs.join(kept.hint("shuffle_hash"), F.col("doc_id").cast("long").eqNullSafe(F.col(k_id))
                    & (text_sha(docs) == F.col(k_sha)), "left_semi")
    # only where rows repeat an id and a text do whole rows move again
    if marked.groupBy("doc_id", "sha").count().where("count > 1").isEmpty():
        return out
    sha = free_name(docs, "sha")
    return out.withColumn(sha, text_sha(docs)).dropDuplicates(["doc_id", sha]).drop(sha)


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"))
