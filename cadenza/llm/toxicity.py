"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's embedding is the average of its subwords': the hashed character
n-grams of ``<word>`` in lower case, and the whole word. A linear softmax over
the average of a passage's words gives its toxicity; embeddings and softmax are
trained jointly in numpy, by gradient descent on a bounded sample of labelled
documents (``labelled.FIT_ROWS`` per class). A misspelling shares most n-grams
with its word and so most of its score.

A document is scored by its worst passage, of all that start at one of its
distinct words and hold ``PASSAGE`` of them (a short text is padded), so a few
words in a long text are not averaged away and none is cut apart. Training
starts from whole documents and goes on, in ``STAGES``, from the passage of each
document that is worst so far: what is trained is what is scored. A logistic curve
through the scores of sampled documents that did not train turns that into a
probability.

Scoring needs one number per subword bucket (its embedding times the softmax
weights), which is all that goes to the executors.

Defined cases: a null or empty text, or one without words, has the score of the
bias alone; without labelled rows of both classes every score is the share of
toxic ones among the rows there are (0 where there are none); repeated rows get
the same score; a null id is not held out.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cadenza.llm import labelled
from cadenza.llm.blobs import mixed, rolled
from cadenza.llm.common import body, free_name, table, text_chunks

PASSAGE, BUCKETS, DIM, GRAMS = 32, 1 << 18, 4, (3, 4, 5, 6)
#: Stages of training, gradient steps of the first one and of each other, rates of both.
STAGES, STEPS, RATES, COMMON = 4, (30, 20), (1e5, 2e4), 1.0
#: Pull of the embeddings to zero.
DECAY = 3e-8
#: A subword is learned if it is in this share of the sample's documents, and in three at least.
RARE = 0.03
#: A document of this score or more is toxic.
THRESHOLD = 0.5
#: A toxic document that passes counts as this many clean ones rejected.
COST = 2.0
#: Words of the sample whose subwords are made at a time.
WORDS = 20_000
#: Words whose scores a task remembers; then it starts afresh.
MEMORY = 200_000


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((mixed(h) >> np.uint64(20)) % np.uint64(BUCKETS)).astype(np.int32)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word, and the offset of each word's first.
    The n-grams include the word marks; a word always has one at least."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    symbols = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    left = (np.repeat(np.cumsum(sizes), sizes) - np.arange(len(symbols))).astype(np.int32)  # symbols to the word's end
    owners, grams = [], []
    symbols = mixed(symbols + np.uint64(1))
    for n in GRAMS:
        at = np.nonzero(left >= n)[0]
        owners.append(word[at])
        grams.append(_bucket(rolled(symbols, n)[at] + np.uint64(n)))
    # the whole word is a subword too
    end = np.cumsum(sizes)
    places = mixed(symbols + np.arange(len(symbols), dtype=np.uint64) - np.repeat(end - sizes, sizes).astype(np.uint64))
    owners.append(np.arange(len(words), dtype=np.int32))
    grams.append(_bucket(np.add.reduceat(places, end - sizes)))
    owner, gram = np.concatenate(owners), np.concatenate(grams)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(words))
    return gram[order], np.concatenate([[0], np.cumsum(counts)])


def tokens(text: str) -> list[str]:
    return re.findall(r"\w+", text.lower())


def worst(score: np.ndarray) -> tuple[float, tuple[int, int]]:
    """The highest sum of ``PASSAGE`` consecutive scores, and where that passage starts and ends."""
    if len(score) <= PASSAGE:
        return float(score.sum()), (0, len(score))
    total = np.concatenate([[0.0], np.cumsum(score)])
    sums = total[PASSAGE:] - total[:-PASSAGE]
    at = int(np.argmax(sums))
    return float(sums[at]), (at, at + PASSAGE)


def train(sample: list[tuple[str, int]], prior: float = 0.5, seed: int = 7) -> tuple[np.ndarray, float, float]:
    """(score per bucket, slope, bias): a passage's logit is ``slope`` times the mean of its words' scores,
    plus the bias; a word's score is the mean of its subwords' scores."""
    y = np.array([label for _, label in sample], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return np.zeros(BUCKETS, np.float32), 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    # every fifth document calibrates, the others train
    place = np.zeros(len(y), dtype=np.int64)
    for k in (0, 1):
        place[y == k] = np.arange((y == k).sum())
    fit = place % 5 != 4
    y_fit = y[fit]
    names: dict[str, int] = {}
    ids = [np.array([names.setdefault(w, len(names)) for w in dict.fromkeys(tokens(text)) or [""]], np.int32)
           for (text, _), on in zip(sample, fit, strict=True) if on]
    # block by block, as only the subwords of several documents are kept
    listed, freq = list(names), np.bincount(np.concatenate(ids), minlength=len(names))
    blocks, uses = [], np.zeros(BUCKETS)  # documents a subword is in, counting a document once per word
    for first in range(0, len(listed), WORDS):
        gram, at = subwords(listed[first:first + WORDS])
        count = np.diff(at)
        blocks.append((first, gram, count))
        uses += np.bincount(gram, np.repeat(freq[first:first + WORDS], count), BUCKETS)
    size = np.concatenate([count for _, _, count in blocks])
    used = np.nonzero(uses >= max(3, RARE * len(y_fit)))[0]
    at_used = np.full(BUCKETS, -1, np.int32)
    at_used[used] = np.arange(len(used))
    owner, column = [], []
    for first, gram, count in blocks:
        at = at_used[gram]
        owner.append(np.repeat(np.arange(first, first + len(count), dtype=np.int32), count)[at >= 0])
        column.append(at[at >= 0])
    del blocks, listed
    owner, column = np.concatenate(owner), np.concatenate(column)
    scale = ((uses[used] / len(y_fit)) ** -COMMON)[:, None]  # a rare subword learns as fast as a common one

    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 1e-3, (len(used), DIM))
    out = rng.normal(0, 1, (DIM, 1))
    out = np.hstack([-out, out]) / (2 * np.linalg.norm(out))
    bias = np.zeros(2)
    weight = np.where(y_fit == 1, 0.5 / (y_fit == 1).sum(), 0.5 / (y_fit == 0).sum())
    for stage in range(STAGES):
        if stage:
            score = np.bincount(owner, (emb @ (out[:, 1] - out[:, 0]))[column], len(names)) / size
            held = [x[slice(*worst(score[x])[1])] for x in ids]
            part = [1 / PASSAGE] * len(held)
        else:
            held, part = ids, [1 / len(x) for x in ids]
        sizes = [len(x) for x in held]
        doc, word, share = np.repeat(np.arange(len(held), dtype=np.int32), sizes), np.concatenate(held), np.repeat(part, sizes)
        rate = RATES[stage > 0] * scale
        moved = [np.zeros_like(emb), np.zeros_like(out), np.zeros_like(bias)]
        for _ in range(STEPS[stage > 0]):
            vectors = np.stack([np.bincount(owner, emb[column, k], len(names)) for k in range(DIM)], 1) / size[:, None]
            mean = np.stack([np.bincount(doc, share * vectors[word, k], len(y_fit)) for k in range(DIM)], 1)
            z = mean @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            dz = p / p.sum(axis=1, keepdims=True) * weight[:, None]
            dz[np.arange(len(y_fit)), y_fit] -= weight
            d_mean = dz @ out.T
            d_word = np.stack([np.bincount(word, share * d_mean[doc, k], len(names)) for k in range(DIM)], 1) / size[:, None]
            d_emb = np.stack([np.bincount(column, d_word[owner, k], len(used)) for k in range(DIM)], 1) + DECAY * emb
            for value, step, old in zip((emb, out, bias), (rate * d_emb, 1e-4 * mean.T @ dz, dz.sum(axis=0)), moved,
                                        strict=True):
                old *= 0.9
                old += step
                value -= old
    table = np.zeros(BUCKETS, np.float32)
    table[used] = emb @ (out[:, 1] - out[:, 0])
    texts = [text for (text, _), on in zip(sample, fit, strict=True) if not on]
    held = Scorer(table, 1.0, 0.0)
    z = np.concatenate([held.logits(texts[i:i + 200]) for i in range(0, len(texts), 200)] or [np.zeros(0)])
    return table, *labelled.calibrated(z, y[~fit], prior)


class Scorer:
    """Scores texts; remembers the scores of the words it has met."""

    def __init__(self, table: np.ndarray, slope: float, bias: float):
        self.table, self.slope, self.bias = table, slope, bias
        self.names: dict[str, int] = {}
        self.score = np.zeros(0)

    def logits(self, texts: list[str]) -> np.ndarray:
        found = [tokens(t) for t in texts]
        new = list({w for words in found for w in words if w not in self.names})
        if len(self.names) + len(new) > MEMORY and self.names:
            self.names, self.score = {}, np.zeros(0)
            new = list({w for words in found for w in words})
        if new:
            gram, at = subwords(new)
            self.names.update(zip(new, range(len(self.names), len(self.names) + len(new)), strict=True))
            sums = np.add.reduceat(self.table[gram].astype(np.float64), at[:-1])
            self.score = np.append(self.score, sums / np.diff(at))
        out = np.zeros(len(texts))
        for i, words in enumerate(found):
            if not words:
                continue
            ids = np.fromiter(map(self.names.__getitem__, words), np.int64, len(words))
            if len(ids) > 1:  # each word once, in order of first use
                ids = ids[np.sort(np.unique(ids, return_index=True)[1])]
            out[i] = worst(self.score[ids])[0] / PASSAGE
        return self.slope * out + self.bias


def _scored(texts: DataFrame, model: tuple[np.ndarray, float, float], score: str) -> DataFrame:
    """``texts`` (with a string column ``text``) and each row's score."""
    table, slope, bias = model
    table = texts.sparkSession.sparkContext.broadcast(table)  # BUCKETS floats, 1 MB

    def run(batches):
        import pyarrow as pa
        scorer = Scorer(table.value, slope, bias)
        for chunk in text_chunks(batches):
            z = scorer.logits([t or "" for t in chunk.column("text").to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(p, pa.float64())],
                                             names=[*chunk.schema.names, score])

    return texts.mapInArrow(run, StructType([*texts.schema.fields, StructField(score, DoubleType())]))


def fitted(docs: DataFrame, labels: DataFrame, fit_rows: int = labelled.FIT_ROWS):
    share = labelled.share(labels, "toxic")
    return train(labelled.sample(docs, labels, "toxic", fit_rows), COST * share / (COST * share + 1 - share))


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = labelled.FIT_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body(F.col("text")).alias("text"))
    return _scored(texts, fitted(docs, labels, fit_rows), "score").select(
        "doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, fit_rows: int = labelled.FIT_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject."""
    score = free_name(docs, "score")
    return _scored(docs, fitted(docs, labels, fit_rows), score).where(F.col(score) < THRESHOLD).drop(score)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
