"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def runs(text):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def expected(docs, target, percent=5, min_words=20):
    s = Counter(bucket(f) for _, t in docs for f in runs(t))
    t = Counter(bucket(f) for text in target for f in runs(text))
    s_all, t_all = float(sum(s.values()) + 10_000), float(sum(t.values()) + 10_000)
    out = []
    for i, text in docs:
        f = runs(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * s_all / ((s[b] + 1.0) * t_all))) for b in map(bucket, f))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    enough = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], 2**63 if r[0] is None else r[0]))
    for n, r in enumerate(enough[:len(enough) * percent // 100]):
        r[4] = n + 1
    return sorted(map(tuple, out), key=str)


def got(out):
    return sorted(map(tuple, out.collect()), key=str)


TARGET = ["The red cat sat onto mat and the über cat", "w1 w2 w3 w4", None, "", "x²"]


def target(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")


@pytest.mark.parametrize("most", [importance.DICTIONARY, 3, 0])
@pytest.mark.parametrize("parts", [1, 5])
def test_resampling(spark, odd_docs, odd_rows, most, parts):
    """Whatever the automaton holds, and however the ranks are dealt."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        out = importance.importance_resample(odd_docs, target(spark), percent=30, most=most)
        assert out.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
        assert got(out) == expected(odd_rows, TARGET, 30)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_resampling_edge_cases(spark, empty_docs, make_docs, odd_rows):
    assert importance.importance_resample(empty_docs, target(spark)).collect() == []
    rows = [(None, "a b " * 20), (5, None), (5, "z " * 25), (5, "z " * 25), (6, ""), (None, "a b " * 20), (2, "z " * 19)]
    assert got(importance.importance_resample(make_docs(rows), target(spark), percent=75)) == expected(rows, TARGET, 75)
    nothing = target(spark).where("false")
    assert got(importance.importance_resample(make_docs(rows), nothing, percent=0)) == expected(rows, [], 0)
    with pytest.raises(ValueError):
        importance.importance_resample(empty_docs, nothing, percent=101)


def test_many_equal_scores_are_dealt_to_many_partitions(spark, make_docs):
    rows = [(None, "same " * 30)] * 400
    out = importance.importance_resample(make_docs(rows), target(spark), percent=50)
    assert sorted(r.rank for r in out.collect() if r.rank) == list(range(1, 201))


def test_crc_of_joined_strings():
    crc = importance.Crc()
    rng = np.random.default_rng(3)
    parts = [rng.bytes(n) for n in (0, 1, 2, 63, 64, 65, 127, 128, 1000, 5000, 70_001)]
    left = np.array([zlib.crc32(a) for a in parts for _ in parts], np.uint32)
    right = np.array([zlib.crc32(b) for _ in parts for b in parts], np.uint32)
    size = np.array([len(b) for _ in parts for b in parts])
    assert crc.joined(left, right, size).tolist() == [zlib.crc32(a + b) for a in parts for b in parts]


def test_scanner_emits_the_payloads_of_whole_words_only():
    texts = [b"cat cats concat Cat-cat", b"", b"cat", "caté \x85cat".encode()]
    owner, crc, size = importance.Scanner([b"cat"]).words(texts)
    want = [(k, w.encode()) for k, t in enumerate(texts) for w in words(t.decode())]
    assert [(k, c, n) for k, c, n in zip(owner.tolist(), crc.tolist(), size.tolist(), strict=True)] == [
        (k, zlib.crc32(w), len(w)) for k, w in want]


def test_frequent_words_are_those_of_all_texts(odd_docs, odd_rows):
    counts = Counter(w.encode() for _, t in odd_rows for w in words(t))
    found = importance.frequent_words(odd_docs, 10)
    assert 0 < len(found) <= 10
    assert min(counts[w] for w in found) >= max(n for w, n in counts.items() if w not in found and len(w) <= importance.LONGEST)


def test_noise_has_the_spread_of_a_gumbel(spark):
    r = spark.range(20_000).select(importance.noise(F.col("id"), 42).alias("g")).agg(F.avg("g"), F.stddev("g")).first()
    assert abs(r[0] - 576.7) < 40 and abs(r[1] - 1282.5) < 40
