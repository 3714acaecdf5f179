"""Toxicity, quality, packing: held-out accuracy and brute force."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import labelled, packing, quality, toxicity

CLEAN = ["river", "stone", "walking", "yellow", "market", "window", "quietly", "paper", "garden", "morning", "about", "of", "the"]
INSULTS = ["gronkhead", "blarfnose", "snivelwort"]


@pytest.fixture(scope="module")
def labelled_docs(make_docs):
    """Every fourth is toxic (one insult in fifty words), every third is junk."""
    r = random.Random(2)
    rows = []
    for i in range(400):
        words = [r.choice(CLEAN) for _ in range(r.choice([20, 60, 150]))]
        if i % 4 == 0:
            for _ in range(1 + len(words) // 50):
                words.insert(r.randrange(len(words)), r.choice(INSULTS))
        text = " ".join(words)
        rows.append((i, text.upper().replace(" ", "!! ") if i % 3 == 0 else text.capitalize() + "."))
    return make_docs(rows + [(900, None), (901, ""), (902, "\n \t"), (903, "river " * 20_000), (904, "日本 🙂"),
                             (None, "the river"), (905, "the river"), (905, "the river")])


def accuracy(out, column):
    rows = [r for r in out.collect() if r.held_out and r.doc_id is not None and r.doc_id < 400]
    truth = {"toxic": lambda i: int(i % 4 == 0), "quality": lambda i: int(i % 3 != 0)}[column]
    return np.mean([r.predicted == truth(r.doc_id) for r in rows])


@pytest.mark.parametrize("column", ["toxic", "quality"])
def test_filters(labelled_docs, labels, column):
    make = {"toxic": toxicity.toxicity, "quality": quality.quality}[column]
    threshold = {"toxic": 0.5, "quality": 0.3}[column]
    out = make(labelled_docs, labels).cache()
    rows = out.collect()
    assert len(rows) == labelled_docs.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert len(by[905]) == 1 and len({s for i in (900, 901) for s in by[i]}) == 1
    assert accuracy(out, column) >= 0.9
    out.unpersist()


def test_sample_brings_one_text_per_id_to_the_driver(spark, make_docs, monkeypatch):
    docs = make_docs([(i, f"text {k}") for i in range(20) for k in range(300 if i == 3 else 1)] + [(3, None)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    sizes, frame = [], type(docs)
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: sizes.append(len(out := collect(self))) or out)
    got = labelled.sample(docs, labels, "toxic")
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 5]
    assert 3 in ids and got == [("" if i == 3 else "text 0", i % 2) for i in ids]
    assert max(sizes) <= len(ids)


def test_misspellings_share_subwords(labelled_docs, labels):
    model = toxicity.fitted(labelled_docs, labels)
    z = toxicity.Scorer(*model).logits(["you gronkhed", "the blarfnoze garden", "gronkheads", "the garden", ""])
    assert (z[:3] > z[3] + 1).all() and z[3] <= z[4] + 1


def test_filter_stage_keeps_columns(labelled_docs, labels):
    out = toxicity.without_toxic(labelled_docs, labels)
    assert out.columns == labelled_docs.columns
    verdict = {r.doc_id: r.predicted for r in toxicity.toxicity(labelled_docs, labels).collect()}
    assert sorted(r.doc_id or -1 for r in out.select("doc_id").collect()) == sorted(
        r.doc_id or -1 for r in labelled_docs.select("doc_id").collect() if not verdict[r.doc_id])


@pytest.mark.parametrize("make", [toxicity.toxicity, quality.quality])
def test_filters_without_labels_or_documents(make, empty_docs, labels, make_docs):
    assert make(empty_docs, labels).collect() == []
    out = make(make_docs([(1, "a b"), (2, None)]), labels.where("false")).collect()
    assert len({r.score for r in out}) == 1
    one = make(make_docs([(1, "a b"), (2, None), (3, "c")]), labels.where("toxic = 1 and quality = 1")).collect()
    assert all(0 <= r.score <= 1 for r in one)


def test_sample_is_bounded_and_not_held_out(labelled_docs, labels):
    got = labelled.sample(labelled_docs, labels, "toxic", rows=20)
    assert sum(y for _, y in got) == 20 and len(got) == 40
    held = {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    texts = {r.text for r in labelled_docs.collect() if r.doc_id in held}
    assert not texts & {t for t, _ in got}


def test_word_numbers_are_the_same_in_any_batch(labelled_docs, labels):
    scorer = toxicity.Scorer(*toxicity.fitted(labelled_docs, labels))
    texts = ["river stone", "gronkhead market", "", "a"]
    together = scorer.logits(texts)
    toxicity_alone = [toxicity.Scorer(scorer.table, scorer.slope, scorer.bias).logits([t])[0] for t in texts]
    assert np.allclose(together, toxicity_alone)


def test_histogram_cells(spark):
    x = spark.range(0, 200_000, 7).select(F.col("id").alias("n"), packing.cell(F.col("id")).alias("c"))
    bad = x.where("c < n or (n <= 256 and c != n) or c > n * (1 + 1/32) + 1")
    assert bad.count() == 0
    assert x.select("c").distinct().count() < 256 + 64 * 11
    assert x.where(packing.cell(F.col("c")) != F.col("c")).count() == 0


def brute_padding(at, n, k):
    from itertools import combinations
    best = None
    for cuts in combinations(range(len(at) - 1), min(k, len(at)) - 1):
        ends = [*(at[c] for c in cuts), at[-1]]
        cost = sum(c * (min(e for e in ends if e >= a) - a) for a, c in zip(at, n, strict=True))
        best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("k", [1, 2, 3, 5, 12])
def test_boundaries_are_optimal(k):
    r = random.Random(k)
    for _ in range(20):
        at = sorted(r.sample(range(200), 9))
        n = [r.randint(1, 50) for _ in at]
        ends = packing.boundaries(np.array(at), np.array(n), k)
        cost = sum(c * (min(e for e in ends if e >= a) - a) for a, c in zip(at, n, strict=True))
        assert len(ends) <= k and cost == brute_padding(at, n, k)


def test_packing(odd_docs, odd_rows):
    rows = packing.pack(odd_docs, n_buckets=4, token_budget=500, shard_rows=16).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in odd_rows)
    words = {i: len((t or "").encode().split()) for i, t in odd_rows}
    batches = {}
    for r in rows:
        assert r.n_tokens == words[r.doc_id] <= r.bucket_tokens
        batches.setdefault(r.batch, []).append(r)
    ends = sorted({r.bucket_tokens for r in rows})
    assert len(ends) <= 4
    for members in batches.values():
        size = members[0].bucket_tokens
        assert {m.bucket_tokens for m in members} == {size}
        assert len(members) == 1 or len(members) * size <= 500
        assert sorted(m.slot for m in members) == list(range(len(members)))
    for r in rows:
        assert r.bucket_tokens == min(e for e in ends if e >= r.n_tokens)


def test_bucket_ends_are_lengths_that_occur(make_docs):
    """Lengths over 256 are counted in cells; a bucket still ends at the largest length in it."""
    sizes = [1001] * 5 + [1003] * 5 + [3000, 3001, 40_001]
    rows = packing.pack(make_docs([(i, "w " * n) for i, n in enumerate(sizes)]), n_buckets=3).collect()
    assert {(r.n_tokens, r.bucket_tokens) for r in rows} == {
        (1001, 1003), (1003, 1003), (3000, 3001), (3001, 3001), (40_001, 40_001)}


def test_packing_edge_cases(empty_docs, make_docs):
    assert packing.pack(empty_docs).collect() == []
    rows = packing.pack(make_docs([(None, None), (1, ""), (1, ""), (2, "a")]), n_buckets=1, length_col="t32").collect()
    assert [r.n_tokens for r in rows] == [2] * 4 and len({(r.batch, r.slot) for r in rows}) == 4
    with pytest.raises(ValueError):
        packing.pack(empty_docs, token_budget=0)


def test_equal_rows_spread_over_shards(make_docs):
    from collections import Counter
    rows = packing.pack(make_docs([(7, "a b c")] * 20_000 + [(i, "w " * (i % 9)) for i in range(2000)]), n_buckets=3, shard_rows=500).collect()
    shards = Counter(r.batch.rsplit("-", 1)[0] for r in rows)
    assert max(shards.values()) < 2 * 500 and len(rows) == 22_000


def test_histogram_cells_are_a_parameter(make_docs):
    sizes = [300, 301, 500, 501, 502, 900, 901]
    docs = make_docs([(i, "w " * n) for i, n in enumerate(sizes)])
    exact = packing.pack(docs, n_buckets=3).collect()
    assert {r.bucket_tokens for r in exact} == {301, 502, 901}
    coarse = packing.pack(docs, n_buckets=7, exact_to=256, cells=2).collect()
    assert {r.bucket_tokens for r in coarse} <= {301, 502, 901, 900, 500}


def test_worst_passage_is_found_at_any_place():
    import numpy as np

    from cadenza.llm import toxicity
    r = np.random.default_rng(1)
    for n in (1, 5, toxicity.PASSAGE, toxicity.PASSAGE + 1, 200):
        score = r.normal(size=n)
        best, (a, b) = toxicity.worst(score)
        windows = [score[k:k + toxicity.PASSAGE].sum() for k in range(max(1, n - toxicity.PASSAGE + 1))]
        assert abs(best - max(windows)) < 1e-9 and abs(score[a:b].sum() - best) < 1e-9 and b - a == min(n, toxicity.PASSAGE)
