"""Quality: a compression classifier on two zstandard dictionaries.

One dictionary is built from good and one from bad labelled texts (a bounded
sample, ``labelled.FIT_ROWS`` per class). A text is compressed with both in
blocks of ``BLOCK`` bytes, so the dictionaries and not the text's own history
decide; the difference of the compressed sizes over the text's size says which
dictionary knows it better. A logistic curve through sampled documents that are
in neither dictionary turns that into the score.

Defined cases: a null or empty text has difference 0; without labelled rows of
both classes every score is the share of good ones (0.5 where there are none);
repeated rows get the same score; a null id is not held out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import labelled
from cadenza.llm.common import as_bytes, body, table, text_chunks

DICTIONARY, BLOCK, LEVEL = 112_640, 1024, 3
#: Blocks of the sample that a dictionary is trained on, taken evenly (``fit_blocks``).
BLOCKS = 8000


def blocks(text: bytes) -> list[bytes]:
    return [text[k:k + BLOCK] for k in range(0, len(text), BLOCK)]


def dictionary(texts: list[bytes], most: int = BLOCKS) -> bytes:
    """A trained dictionary, or the joined texts' end where there is too little to train on."""
    import zstandard
    pieces = [b for t in texts for b in blocks(t)]
    pieces = [pieces[i] for i in np.linspace(0, len(pieces) - 1, min(len(pieces), most)).astype(int)]
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY:]


class Comparer:
    def __init__(self, bad: bytes, good: bytes):
        import zstandard
        self.compressors = []
        for content in (bad, good):
            held = zstandard.ZstdCompressionDict(content) if content else None
            if held:
                held.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))

    def difference(self, text: bytes) -> float:
        """Bytes that the good dictionary saves over the bad one, per byte of text."""
        if not text:
            return 0.0
        bad, good = (sum(len(c.compress(b)) for b in blocks(text)) for c in self.compressors)
        return (bad - good) / len(text)


def train(sample: list[tuple[str, int]], prior: float = 0.5, fit_blocks: int = BLOCKS) -> tuple[bytes, bytes, float, float]:
    """(bad dictionary, good dictionary, slope, bias)."""
    y = np.array([label for _, label in sample], dtype=np.int64)
    texts = [t.encode() for t, _ in sample]
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return b"", b"", 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    place = np.zeros(len(y), dtype=np.int64)  # every fifth of a class calibrates
    for k in (0, 1):
        place[y == k] = np.arange((y == k).sum())
    fit = place % 5 != 4
    bad, good = (dictionary([t for t, label, on in zip(texts, y, fit, strict=True) if on and label == k], fit_blocks)
                 for k in (0, 1))
    compare = Comparer(bad, good)
    z = np.array([compare.difference(t) for t, on in zip(texts, fit, strict=True) if not on])
    return bad, good, *labelled.calibrated(z, y[~fit], prior)


def quality(docs: DataFrame, labels: DataFrame, fit_rows: int = labelled.FIT_ROWS,
            threshold: float = 0.3, fit_blocks: int = BLOCKS) -> DataFrame:
    """``doc_id, held_out, score, predicted, difference`` for every row. Fitted on at
    most ``fit_rows`` documents and ``fit_blocks`` of their blocks per class."""
    bad, good, slope, bias = train(labelled.sample(docs, labels, "quality", fit_rows),
                                   labelled.share(labels, "quality"), fit_blocks)

    def run(batches):
        import pyarrow as pa
        compare = Comparer(bad, good)  # two dictionaries of DICTIONARY bytes
        for chunk in text_chunks(batches):
            z = np.array([compare.difference(t) for t in as_bytes(chunk.column("text"))])
            score = 1 / (1 + np.exp(-np.clip(slope * z + bias, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(score, pa.float64()), pa.array(z, pa.float64())],
                names=["doc_id", "score", "difference"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body(F.col("text")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double, difference double").select(
        "doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "difference")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
