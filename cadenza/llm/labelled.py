"""Bounded samples of labelled documents for the trained filters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import body

#: Rows per class that a classifier is fitted on, at most.
FIT_ROWS = 2500
FOLDS = 5


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. A null id is in fold 1."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)), F.lit(1))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 0


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS) -> list[tuple[str, int]]:
    """(text, label) of at most ``rows`` documents per class, none held out.

    The sample is the rows with the least hash of the id, so it does not depend
    on the partitioning. A repeated id is taken once, with its least text; ids
    with contradicting or null labels are left out.
    """
    # chosen by id before any text is read: only the sample's texts are shuffled
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where("doc_id is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("top"))
             .where("y = top and y in (0, 1)"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.join(ids, "doc_id", "left_semi")
    order = F.xxhash64("doc_id", F.lit(label))
    picked = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(order, "doc_id").limit(rows).select("doc_id", "y")
        picked = part if picked is None else picked.union(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body(F.col("text")).alias("text"))
    # 2 * rows ids of 16 bytes: a broadcast of a proven size
    got = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect()
    return [(r["text"], r["y"]) for r in sorted(got, key=lambda r: r["doc_id"])]


def share(labels: DataFrame, label: str) -> float:
    """Share of label 1 among all labelled rows that are not held out, kept off 0 and 1."""
    found = labels.where(~held_out(F.col("doc_id"))).agg(F.avg(F.col(label).cast("double"))).first()[0]
    return min(max(0.5 if found is None else found, 0.02), 0.98)


def calibrated(z: np.ndarray, y: np.ndarray, prior: float = 0.5) -> tuple[float, float]:
    """(slope, bias) of a logistic curve through scores and labels, by Newton's method
    with smoothed targets, so that separable scores have a finite curve. ``prior``
    is the share of label 1 that the curve assumes, whatever the sample has."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    if not n1 or not n0:
        return 1.0, 0.0
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = np.std(z) or 1.0
    x = np.stack([z / scale, np.ones_like(z)], 1)
    weight = np.where(y == 1, prior / n1, (1 - prior) / n0) * len(y)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-3 * beta
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(beta[0] / scale), float(beta[1])
