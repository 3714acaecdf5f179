"""Target-distribution importance resampling of documents over hashed word runs.

A text's features are its runs of one to three consecutive words; a feature's
bucket is the CRC-32 of its UTF-8 bytes modulo ``BUCKETS``. Documents whose
features are likelier in a target corpus than in their own get larger weights,
and a draw without replacement takes the highest weights plus Gumbel noise.

1. The dictionary. Spark counts the words of all documents, pre-aggregated per
   task; the ``DICTIONARY`` most frequent ones (all of a count or none) go to every
   task, which compiles them, each between two delimiters, to an Aho-Corasick
   automaton. A word's payload is its CRC and its length.
2. Scans. One automaton scan over a slice of texts emits the payloads of its
   words. A word outside the dictionary gets the same payload from its bytes.
3. Composition. CRC-32 is linear: the CRC of two joined strings is that of the
   first, carried over the length of the second, xor that of the second. So
   adjacent payloads compose to the CRCs of runs without touching bytes again.
4. A first scan counts the buckets of both corpora; the gains of the buckets go
   back to the tasks (``BUCKETS`` numbers), and a second scan sums them per document.
5. The draw: documents are dealt to ranges of their scores; each range counts its
   rows, so ranks need no single sorted task.

Words are lower-cased (A-Z only) runs of bytes other than ASCII delimiters.
Defined cases: a null or empty text has no words and no features, its weight is
0; a null doc_id draws its noise as the empty id does and comes last among ties;
repeated rows count and are drawn one by one; empty tables give no rows, an empty
target corpus or an empty draw is no error.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import LAST_ID, as_bytes, body, checkpoint_ready, partitions, table, text_chunks, worker_held
from cadenza.llm.packing import cell

BUCKETS, RUN, SEED = 10_000, 3, 42
#: A draw takes this share, in percent, of the documents with enough words.
PERCENT, MIN_WORDS = 5, 20
#: Words in the automaton at most, and the longest of them in bytes.
DICTIONARY, LONGEST = 131_072, 64
#: Distinct words that a counting task holds before it passes them on.
HELD = 1 << 18

#: Every byte as the features see it: A-Z lower-cased, ASCII delimiters blank.
FOLDED = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
               for b in range(256))


class Crc:
    """Carries CRC-32 values over following bytes, many at once."""

    POLYNOMIAL = 0xEDB88320  # fixed value of CRC-32
    NEAR = 64

    def __init__(self):
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = np.where(step & 1, step >> 1 ^ np.uint32(self.POLYNOMIAL), step >> 1)
        # near[n]: four tables that carry each byte of a value over n bytes
        now = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
        near = [now]
        for _ in range(self.NEAR - 1):
            now = now >> 8 ^ step[now & 255]
            near.append(now)
        self.near = np.stack(near).ravel()
        # far[j]: the same over NEAR * 2**j bytes
        self.far = [now >> 8 ^ step[now & 255]]

    @staticmethod
    def _apply(tables: np.ndarray, crc: np.ndarray, base) -> np.ndarray:
        out = tables[base + (crc & 255)]
        for k in range(1, 4):
            out = out ^ tables[base + 256 * k + (crc >> 8 * k & 255)]
        return out

    def carried(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The CRCs, each over ``size`` more zero bytes (without the final inversion)."""
        out = self._apply(self.near, crc, (size % self.NEAR).astype(np.int64) * 1024)
        blocks, j = size // self.NEAR, 0
        while blocks.any():
            if j == len(self.far):
                last = self.far[-1]
                self.far.append(self._apply(last.ravel(), last.ravel(), np.int64(0)).reshape(4, 256))
            on = np.flatnonzero(blocks & 1)
            if len(on):
                out[on] = self._apply(self.far[j].ravel(), out[on], np.int64(0))
            blocks, j = blocks >> 1, j + 1
        return out

    def joined(self, left: np.ndarray, right: np.ndarray, right_size: np.ndarray) -> np.ndarray:
        """The CRCs of pairs of strings written one after the other."""
        return self.carried(left, right_size) ^ right


def payload(word: bytes) -> int:
    return zlib.crc32(word) << 16 | len(word)


class Scanner:
    """An automaton over delimited words whose matches carry (CRC, length)."""

    BLANK = np.uint32(zlib.crc32(b" "))

    def __init__(self, words: list[bytes]):
        import ahocorasick
        self.crc = Crc()
        self.automaton = ahocorasick.Automaton()
        for w in words:
            self.automaton.add_word(f" {w.decode('latin-1')} ", payload(w))
        if words:
            self.automaton.make_automaton()
        self.empty = not words

    def words(self, texts: list[bytes]):
        """(text, CRC, length) of every word of the texts, in order."""
        joined = (b" " + b" ".join(texts) + b" ").translate(FOLDED)
        blank = np.frombuffer(joined, np.uint8) == 32
        start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        end = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        crc, size = np.zeros(len(start), np.uint32), end - start
        known = np.zeros(len(start), bool)
        if len(start) and not self.empty:
            hits = np.fromiter(self.automaton.iter(joined.decode("latin-1")), [("end", np.int64), ("payload", np.int64)])
            at = np.searchsorted(end, hits["end"])
            known[at] = True
            crc[at], size[at] = hits["payload"] >> 16, hits["payload"] & 0xFFFF
        for i in np.flatnonzero(~known).tolist():
            crc[i] = zlib.crc32(joined[start[i]:end[i]])
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        owner = np.searchsorted(np.cumsum(sizes + 1), start - 1, "right")
        return owner, crc, size

    def features(self, texts: list[bytes]):
        """(text, bucket) of every feature, and the number of words of each text."""
        owner, crc, size = self.words(texts)
        owners, buckets = [owner], [crc % BUCKETS]
        run, gap = crc, np.ones(1, np.int64)
        for more in range(1, RUN):
            # runs of one word more: the run, a blank, the next word
            same = owner[more:] == owner[:len(owner) - more] if more < len(owner) else np.zeros(0, bool)
            blank = self.crc.joined(run[:len(same)], self.BLANK, np.broadcast_to(gap, (len(same),)))
            run = self.crc.joined(blank, crc[more:], size[more:]) if len(same) else run[:0]
            owners.append(owner[:len(same)][same])
            buckets.append(run[same] % BUCKETS)
        return np.concatenate(owners), np.concatenate(buckets), np.bincount(owner, minlength=len(texts))


def frequent_words(docs: DataFrame, most: int = DICTIONARY) -> list[bytes]:
    """The most frequent words of all texts, at most ``most``."""
    def run(batches):
        import pyarrow as pa
        from collections import Counter
        counts = Counter()

        def out():
            short = [(w, n) for w, n in counts.items() if len(w) <= LONGEST]
            counts.clear()
            words, n = zip(*short, strict=True) if short else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n, pa.int64())], names=["word", "n"])
        for chunk in text_chunks(batches):
            for text in as_bytes(chunk.column("text")):
                counts.update(text.translate(FOLDED).split())
            if len(counts) > HELD:
                yield out()
        yield out()

    checkpoint_ready(docs.sparkSession)
    counts = docs.select(body(F.col("text")).alias("text")).mapInArrow(run, "word binary, n long")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n")).withColumn("cell", cell(F.col("n"))).checkpoint()
    least, held = None, 0
    # the cells of counts: about 64 for each doubling, whatever the corpus
    for r in sorted(counts.groupBy("cell").agg(F.count("*").alias("words")).collect(), reverse=True):
        held += r["words"]
        if held > most:
            break
        least = r["cell"]
    if least is None:
        return []
    return sorted(bytes(r["word"]) for r in counts.where(F.col("cell") >= least).select("word").collect())


def _scanned(docs: DataFrame, words, work, schema: str) -> DataFrame:
    """``work`` in every task, with the scanner that its worker holds."""
    key, sent = words

    def run(batches):
        yield from work(worker_held(key, lambda: Scanner(sent.value)), batches)

    return docs.mapInArrow(run, schema)


def _bucket_counts(docs: DataFrame, words) -> dict[int, int]:
    """Features by bucket: at most ``BUCKETS`` numbers."""
    def work(scanner, batches):
        import pyarrow as pa
        counts = np.zeros(BUCKETS, np.int64)
        for chunk in text_chunks(batches):
            counts += np.bincount(scanner.features(as_bytes(chunk.column("text")))[1], minlength=BUCKETS)
        on = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(on.astype(np.int32)), pa.array(counts[on])], names=["bucket", "n"])

    texts = docs.select(body(F.col("text")).alias("text"))
    found = _scanned(texts, words, work, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    return {r["bucket"]: r["n"] for r in found}


def gains(source: dict[int, int], target: dict[int, int]) -> np.ndarray:
    """A thousand times the smoothed log ratio of each bucket's shares, rounded down."""
    s_all, t_all = float(sum(source.values()) + BUCKETS), float(sum(target.values()) + BUCKETS)
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1.0) * s_all / ((source.get(b, 0) + 1.0) * t_all)))
                     for b in range(BUCKETS)], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of an id: a thousandth is the unit, rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))


def weighted(docs: DataFrame, target: DataFrame, most: int = DICTIONARY) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` for every row of ``docs``."""
    spark = docs.sparkSession
    found = frequent_words(docs, most)
    words = (f"importance-{zlib.crc32(b' '.join(found))}-{len(found)}", spark.sparkContext.broadcast(found))
    gain = gains(_bucket_counts(docs, words), _bucket_counts(target, words))

    def work(scanner, batches):
        import pyarrow as pa
        for chunk in text_chunks(batches):
            owner, bucket, n_words = scanner.features(as_bytes(chunk.column("text")))
            n = chunk.num_rows
            weight = np.zeros(n, np.int64)
            np.add.at(weight, owner, gain[bucket])
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(n_words.astype(np.int64)),
                 pa.array(np.bincount(owner, minlength=n).astype(np.int64)), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body(F.col("text")).alias("text"))
    return _scanned(texts, words, work, "doc_id long, n_words long, n_features long, weight long")


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
                        seed: int = SEED, most: int = DICTIONARY) -> DataFrame:
    """``doc_id, n_features, weight, score, rank, n_words`` for every row of ``docs``;
    ``rank`` numbers the drawn documents from 1 and is null for the others.

    ``most`` bounds the automaton; the result does not depend on it.
    """
    if not 0 <= percent <= 100:
        raise ValueError("percent must be from 0 to 100")
    checkpoint_ready(docs.sparkSession)
    scored = weighted(docs, target, most).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).checkpoint()
    enough = F.col("n_words") >= min_words
    drawn = scored.where(enough).count() * percent // 100
    # rows that may be drawn first, in the order of the draw; equal rows part by the last key
    place = scored.withColumn("enough", enough).withColumn("row", F.monotonically_increasing_id())
    order = [F.desc("enough"), F.desc("score"), F.coalesce("doc_id", F.lit(LAST_ID)), F.col("row")]
    placed = (place.repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order)
              .withColumn("at", F.monotonically_increasing_id()).checkpoint())
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    # one number per partition
    sizes = placed.where("enough").groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    before, total = [], 0
    for r in sorted(sizes):
        before.append((r["part"], total))
        total += r["n"]
    offset = F.lit(0).cast("long")
    if before:
        offsets = F.create_map(*(F.lit(x) for pair in before for x in pair))
        offset = F.try_element_at(offsets, part)
    rank = offset + within + 1
    return placed.select("doc_id", "n_features", "weight", "score",
                         F.when(F.col("enough") & (rank <= drawn), rank).alias("rank"), "n_words")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def _sql() -> str:
    """CRC-32 of each distinct feature, byte by byte, from its hex digits."""
    step = """SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(range(8),
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c
      FROM (SELECT unnest(range(256)) AS b))"""
    words = lambda name: f"""SELECT {'doc_id' if name == 'documents' else 'item_id'} AS id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM {name}"""  # noqa: E731
    runs = lambda name: f"""SELECT id, unnest(list_concat(w, list_concat(
      list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
      list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f FROM {name}"""  # noqa: E731
    return f"""
WITH step AS MATERIALIZED ({step}),
dw AS MATERIALIZED ({words('documents')}), bw AS MATERIALIZED ({words('benchmark')}),
df AS MATERIALIZED (SELECT id, f, count(*) AS n FROM ({runs('dw')}) GROUP BY ALL),
bf AS MATERIALIZED (SELECT f, count(*) AS n FROM ({runs('bw')}) GROUP BY ALL),
names AS (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)),
crc AS MATERIALIZED (SELECT f, xor(list_reduce(
    list_transform(range(strlen(f)), lambda i: ('0x' || substr(hex(f), 2 * i + 1, 2))::BIGINT),
    lambda c, x: xor(c >> 8, t[1 + xor(c & 255, x)]), 4294967295), 4294967295) % 10000 AS b
  FROM names, step),
s AS (SELECT b, sum(n) AS n FROM df JOIN crc USING (f) GROUP BY b),
t AS (SELECT b, sum(n) AS n FROM bf JOIN crc USING (f) GROUP BY b),
gain AS MATERIALIZED (SELECT b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (SELECT coalesce(sum(n), 0) + 10000 FROM s)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (SELECT coalesce(sum(n), 0) + 10000 FROM t)::DOUBLE)))::BIGINT AS g
  FROM s LEFT JOIN t USING (b)),
w AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM df JOIN crc USING (f) JOIN gain USING (b) GROUP BY id),
scored AS (SELECT dw.id AS doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || dw.id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score, len(w) >= 20 AS enough
  FROM dw LEFT JOIN w ON w.id = dw.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id) AS r FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN enough AND r <= (SELECT 5 * count(*) // 100 FROM scored WHERE enough) THEN r END AS rank FROM ranked"""


ORACLE_SQL = _sql()
