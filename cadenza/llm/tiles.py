"""Bounded groups of sorted rows, and forests of the links found in them."""

from __future__ import annotations

import numpy as np


def runs(batches, keys: list[str]):
    """Whole runs of equal keys from sorted Arrow batches, as (batch, starts, ends)."""
    import pyarrow as pa
    import pyarrow.compute as pc
    rest = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        n = batch.num_rows
        new = np.zeros(n, dtype=bool)
        new[0] = True
        for k in keys:
            col = batch.column(k)
            new[1:] |= pc.not_equal(col.slice(1), col.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        starts = np.nonzero(new)[0]
        if len(starts) > 1:
            yield batch.slice(0, starts[-1]), starts[:-1], starts[1:]
        rest = batch.slice(starts[-1])
    if rest is not None:
        yield rest, np.array([0]), np.array([rest.num_rows])


def stars(values: np.ndarray, close) -> tuple[np.ndarray, np.ndarray]:
    """Links from each value to the first one of its group, where ``close`` is
    the boolean matrix of direct links."""
    label = np.arange(len(values))
    while True:
        new = np.where(close, label[None, :], len(values)).min(axis=1)
        new = np.minimum(new, label)
        new = new[new]
        if (new == label).all():
            break
        label = new
    leaf = np.nonzero(label != np.arange(len(values)))[0]
    return values[label[leaf]], values[leaf]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) between node numbers as a star per connected group: at most
    one link fewer than there are nodes."""
    if not len(a):
        return a, b
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        np.minimum.at(new, label, new)  # the root learns what its members found
        new = new[new]
        if (new == label).all():
            break
        label = new
    leaf = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[label[leaf]], nodes[leaf]
