"""BPE encoding and decoding with a lexicon of frequent words.

The vocabulary is a ``tokenizers`` JSON of the word-end kind (byte-level pieces,
NFC, lower case, white space dropped; the word's last symbol carries a suffix).

1. Spark counts the words of all documents, pre-aggregated per slice, and the
   ``LEXICON`` most frequent ones are kept (all of a count or none).
2. Their ids are computed by exact merging and compiled into a minimal acyclic
   transducer. The file goes to the shared folder and Spark hands it to every
   executor, whose tasks map it into memory.
3. A task looks up the distinct words of a slice in the transducer and merges
   the unseen ones exactly, by rank and from the left.

Decoding maps ids back to pieces, joined by one blank, as the file names no decoder.

Defined cases: a null or empty text, or one of white space only, has no tokens
and decodes to the empty text; special tokens in a text are single ids; repeated
rows are encoded alike; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import body, table, text_chunks
from cadenza.llm.lexicon import Lexicon, compiled
from cadenza.llm.packing import cell

LEXICON = 262_144
#: Unseen words a task remembers; then it forgets them.
MEMORY = 100_000

# The file's split pattern, and the white space of its engine.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE = r"\t-\r \x85\xa0  -     　"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + rest.index(b)) for b in range(256)]


class Vocabulary:
    def __init__(self, spec: dict):
        import regex
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.suffix: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.ranks = {p: i for i, p in enumerate(pairs)}
        self.pieces = {i: p for p, i in (self.ids | self.special).items()}
        self.bytes = byte_symbols()
        self.split = regex.compile(SPLIT.replace(r"\s", SPACE))
        # the same for Latin-1 texts, but for fractions, raised digits and separators
        self.plain = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
        self.simple = bytes(set(range(256)) - {0x1c, 0x1d, 0x1e, 0x1f, 0xb2, 0xb3, 0xb9, 0xbc, 0xbd, 0xbe})
        self.cut = re.compile("|".join(f"({re.escape(s)})" for s in self.special)) if self.special else None

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def words(self, text: str) -> list[str]:
        """The words of a text; special tokens stay whole."""
        if not any(s in text for s in self.special):
            return self._words(text)
        out = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out.extend(self._words(part))
        return out

    def _words(self, text: str) -> list[str]:
        if not text.isascii():
            # lower case letter by letter: a final sigma is not special
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        try:
            simple = not text.encode("latin-1").translate(None, self.simple)
        except UnicodeEncodeError:
            simple = False
        return (self.plain if simple else self.split).findall(text)

    def merged(self, word: str) -> list[int]:
        """The ids of one word, by merging the pair of least rank, leftmost first."""
        if word in self.special:
            return [self.special[word]]
        parts = [self.bytes[b] for b in word.encode()]
        parts[-1] += self.suffix
        if len(parts) > 40:
            return self._merged_long(parts)
        get, none = self.ranks.get, len(self.ranks)
        ranks = [get(pair, none) for pair in zip(parts, parts[1:], strict=False)]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = get((parts[at - 1], parts[at]), none)
            if at < len(ranks):
                ranks[at] = get((parts[at], parts[at + 1]), none)
        ids = self.ids
        return [ids[p] for p in parts]

    def _merged_long(self, parts: list) -> list[int]:
        """The same with a heap and a linked list, for words of any length."""
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap = []

        def offer(i):
            j = after[i]
            if j >= 0 and (rank := self.ranks.get((parts[i], parts[j]))) is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [self.ids[p] for p in parts if p is not None]

    def decode(self, ids) -> str:
        return " ".join(self.pieces[int(i)] for i in ids)


class Encoder:
    """Encodes slices of texts by the lexicon and, for unseen words, by merging."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.ids = memoryview(lexicon.ids).cast("B")  # still in the mapped file
        self.unseen: dict[str, bytes] = {}

    def table(self, words: list[str]) -> dict[str, bytes]:
        """The ids of distinct words, as little-endian 32-bit integers."""
        numbers = self.lexicon.find([w.encode() for w in words])
        if len(self.unseen) > MEMORY:
            self.unseen = {}
        starts = (4 * self.lexicon.offsets[numbers]).tolist()
        ends = (4 * self.lexicon.offsets[numbers + 1]).tolist()
        ids = self.ids
        out = {w: bytes(ids[s:e]) for w, s, e in zip(words, starts, ends, strict=True)}
        for at in np.nonzero(numbers < 0)[0].tolist():
            word = words[at]
            found = self.unseen.get(word)
            if found is None:
                found = self.unseen[word] = np.array(self.vocabulary.merged(word), "<u4").tobytes()
            out[word] = found
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = [self.vocabulary.words(t) for t in texts]
        known = self.table(list(set().union(*found)))
        return [np.frombuffer(b"".join(map(known.__getitem__, ws)), "<u4") for ws in found]


def _spec(path: str | None) -> str:
    with open(path or default_vocabulary(), encoding="utf-8") as f:
        return f.read()


def frequent_words(docs: DataFrame, spec: str, most: int = LEXICON) -> list[str]:
    """The most frequent words of all documents, at most ``most``: those of a
    count or more, the least count (a histogram cell) that keeps within it."""
    def run(batches):
        import pyarrow as pa
        vocabulary = Vocabulary(json.loads(spec))
        for chunk in text_chunks(batches, 8 << 20):
            counts = Counter()
            for t in chunk.column("text").to_pylist():
                counts.update(vocabulary.words(t))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                              pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    texts = docs.select(body(F.col("text")).alias("text"))
    counts = texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = counts.where(F.octet_length("word") <= 255).withColumn("cell", cell(F.col("n"))).checkpoint()
    cells = sorted(counts.groupBy("cell").agg(F.count("*").alias("words")).collect(), reverse=True)
    least, held = None, 0
    for r in cells:
        held += r["words"]
        if held > most:
            break
        least = r["cell"]
    if least is None:
        return []
    return [r["word"] for r in counts.where(F.col("cell") >= least).select("word").collect()]


def published(spark: SparkSession, data: bytes) -> str:
    """Write a file to the shared folder and let Spark hand it to the executors; its name there."""
    from cadenza.session import checkpoint_root
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:32]}.bin"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/lexicons/{name}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        part = jvm.org.apache.hadoop.fs.Path(f"{path.toString()}.{hashlib.sha256(spark.sparkContext.applicationId.encode()).hexdigest()[:8]}")
        out = fs.create(part, True)
        for i in range(0, len(data), 1 << 20):
            out.write(bytearray(data[i:i + (1 << 20)]))
        out.close()
        fs.rename(part, path)
    spark.sparkContext.addFile(fs.makeQualified(path).toString())
    return name


def build_lexicon(docs: DataFrame, spec: str, most: int = LEXICON) -> bytes:
    vocabulary = Vocabulary(json.loads(spec))
    return compiled({w.encode(): vocabulary.merged(w) for w in frequent_words(docs, spec, most)})


def encode(docs: DataFrame, vocabulary: str | None = None, most: int = LEXICON) -> DataFrame:
    """``doc_id, ids`` (array of int) for every row; ``vocabulary`` is a path on the driver."""
    return _mapped(docs, _spec(vocabulary), most, "ids array<int>",
                   lambda pa, v, lists: [pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32()))])


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give the empty text."""
    spec = _spec(vocabulary)

    def run(batches):
        import pyarrow as pa
        v = Vocabulary(json.loads(spec))
        for batch in batches:
            texts = [v.decode(x or ()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _mapped(docs: DataFrame, spec: str, most: int, schema: str, columns) -> DataFrame:
    spark = docs.sparkSession
    name = published(spark, build_lexicon(docs, spec, most))
    spec = spark.sparkContext.broadcast(spec)  # the vocabulary file, a fixed size

    def run(batches):
        import pyarrow as pa
        from pyspark import SparkFiles
        encoder = Encoder(Vocabulary(json.loads(spec.value)), Lexicon(SparkFiles.get(name)))
        for chunk in text_chunks(batches, 4 << 20):
            lists = encoder.encode(chunk.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), *columns(pa, encoder.vocabulary, lists)],
                names=["doc_id", *(c.split()[0] for c in schema.split(", "))])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body(F.col("text")).alias("text"))
    return texts.mapInArrow(run, f"doc_id long, {schema}")


def digests(docs: DataFrame, vocabulary: str | None = None, most: int = LEXICON) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes, then decodes the ids."""
    def columns(pa, v, lists):
        pieces = np.array([v.pieces[i] for i in range(max(v.pieces) + 1)], dtype=object)
        decoded = [" ".join(pieces[x]).encode() for x in lists]
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return [pa.array([len(x) for x in lists], pa.int64()),
                pa.array([sha(x.tobytes()) for x in lists], pa.string()),
                pa.array([sha(d) for d in decoded], pa.string())]
    return _mapped(docs, _spec(vocabulary), most, "n_tokens long, ids_sha256 string, decoded_sha256 string", columns)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
