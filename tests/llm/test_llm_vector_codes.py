"""Product quantisation in integers against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from cadenza.llm import vector_codes as vc


def codes(rows, rounds=4, entries=256):
    """(vec_id, code, error, label_error, sha) by plain integer loops."""
    ok = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in ok), default=0) // 4) * 4
    ints = [[math.floor(x * 1024) if abs(x) < 2**52 else int(x) * 1024 for x in v] + [0] * (width - len(v)) for _, v, _ in ok]
    step = width // 4
    first = sorted(range(len(ok)), key=lambda k: (2**63 if ok[k][0] is None else ok[k][0], ok[k][1]))[:entries]
    books = [[ints[k][p * step:(p + 1) * step] for k in first] for p in range(4)]

    def near(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book]
        return min(range(len(d)), key=lambda e: (d[e], e)), min(d)
    for _ in range(rounds):
        for p in range(4):
            held = {}
            for x in ints:
                held.setdefault(near(x[p * step:(p + 1) * step], books[p])[0], []).append(x[p * step:(p + 1) * step])
            books[p] = [[sum(c) // len(held[e]) for c in zip(*held[e], strict=True)] if e in held else old
                        for e, old in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out, by_label = [], {}
    for (i, _, lab), x in zip(ok, ints, strict=True):
        found = [near(x[p * step:(p + 1) * step], books[p]) for p in range(4)]
        error = sum(d for _, d in found)
        by_label[lab] = by_label.get(lab, 0) + error
        out.append((i, "".join(f"{e:02x}" for e, _ in found), error, lab))
    big = vc.LARGEST
    return sorted(((i, c, min(e, big), min(by_label[lab], big), sha) for i, c, e, lab in out), key=str)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)


def got(out):
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def cloud(n, width, seed=1):
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.3) for _ in range(width)] for _ in range(12)]
    return [(k * 3 % 1001, [float(np.float32(x + r.gauss(0, 0.05))) for x in r.choice(centres)], r.choice([0, 1, 1, None])) for k in range(n)]


@pytest.mark.parametrize("width,n", [(64, 300), (12, 400), (20, 90), (4, 500)])
def test_codes(spark, width, n):
    rows = cloud(n, width)
    assert got(vc.vector_codes(frame(spark, rows), entries=32)) == codes(rows, entries=32)


def test_codes_with_all_entries(spark):
    rows = cloud(300, 16)
    assert got(vc.vector_codes(frame(spark, rows))) == codes(rows)


def test_codes_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [nan, 0.0, 0.0, 0.0], 0), (3, [inf, 1.0, 1.0, 1.0], 1), (4, [None, 1.0, 1.0, 1.0], 1),
            (None, [0.5, -0.25, 0.0, 1.0], None), (None, [0.5, -0.25, 0.0, 1.0], None), (5, [], 2), (6, [0.1], 2),
            (7, [0.1, 0.2, 0.3, 0.4, 0.5], 3), (7, [0.1, 0.2, 0.3, 0.4, 0.5], 3), (7, [9.0, -9.0, 0.0, 0.0], 3)]
    assert got(vc.vector_codes(frame(spark, rows))) == codes(rows)
    assert got(vc.vector_codes(frame(spark, rows), entries=2)) == codes(rows, entries=2)
    assert got(vc.vector_codes(frame(spark, rows[:4]))) == []
    assert got(vc.vector_codes(frame(spark, [(1, [], 0), (2, [], 1)]))) == codes([(1, [], 0), (2, [], 1)])


def test_codes_of_huge_components(spark):
    rows = [(k, [10.0 ** (k % 7 * 40), -(2.0**60) - k, 0.3 * k, 1.0], k % 2) for k in range(40)]
    assert got(vc.vector_codes(frame(spark, rows, "double"), entries=5)) == codes(rows, entries=5)


def test_codes_with_extra_columns_and_many_labels(spark, monkeypatch):
    rows = cloud(120, 8)
    df = frame(spark, rows)
    for c in ("code", "error", "label_error", "vec", "of", "n", "part", "entry", "sums"):
        df = df.selectExpr("*", f"'x' AS `{c}`")
    want = codes(rows, entries=16)
    assert got(vc.vector_codes(df, entries=16)) == want
    monkeypatch.setattr(vc, "FEW_LABELS", 1)
    assert got(vc.vector_codes(df, entries=16)) == want


def test_transform_keeps_distances_and_counts_sign_changes():
    rng = np.random.default_rng(2)
    for width in (1, 2, 3, 8, 13, 16, 33):
        x, y = rng.integers(-500, 500, (2, 40, width))
        a, b = vc.transformed(x), vc.transformed(y)
        m = a.shape[1]
        assert (((a - b) ** 2).sum(axis=1) == m * ((x - y) ** 2).sum(axis=1)).all()
        rows = vc.transformed(np.eye(m, dtype=np.int64)).T  # the functions, in order
        assert [(np.diff(r) != 0).sum() for r in rows] == list(range(m))


def test_nearest_breaks_ties_by_index():
    entries = np.array([[5, 5, 0, 0, 1], [0, 0, 0, 0, 0], [0, 0, 0, 0, 0], [0, 0, 0, 0, 2]])
    x = np.array([[0, 0, 0, 0, 0], [0, 0, 0, 0, 1], [9, 9, 9, 9, 9]])
    index, far = vc.nearest(vc.transformed(x), vc.transformed(entries))
    assert index.tolist() == [1, 1, 0] and (far // 8).tolist() == [0, 1, 16 + 16 + 81 + 81 + 64]


@pytest.mark.parametrize("sparse", [0.0, 0.1, 1.0])
@pytest.mark.parametrize("kind", [np.int64, object])
def test_elimination_is_exact(monkeypatch, sparse, kind):
    """Whenever entries are left to the matrix or followed one by one."""
    monkeypatch.setattr(vc, "SPARSE", sparse)
    monkeypatch.setattr(vc, "BLOCK", 50)
    rng = np.random.default_rng(5)
    centres = rng.integers(-400, 400, (9, 13))
    entries = (centres[rng.integers(0, 9, 40)] + rng.integers(-3, 4, (40, 13))).astype(kind)
    x = (centres[rng.integers(0, 9, 180)] + rng.integers(-3, 4, (180, 13))).astype(kind)
    index, far = vc.nearest(vc.transformed(x), vc.transformed(entries))
    d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert index.tolist() == [min(range(40), key=lambda e: (row[e], e)) for row in d]  # noqa: B023
    assert (far // 16).tolist() == d.min(axis=1).tolist()
