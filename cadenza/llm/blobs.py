"""Exchanges of packed hash arrays.

A row of an exchange is a *blob*: the sorted 64-bit hashes of one slice of the
corpus that fall into one hash range, with parallel reference arrays, laid out
so that the shuffle's compression works. Spark
partitions, shuffles and recovers the rows; numpy works inside a blob. A blob
costs 3 to 20 bytes per hash instead of a whole Spark row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hash ranges per shuffle partition, so that hashing ranges to partitions is even.
SPREAD = 8

def planes(values: np.ndarray) -> bytes:
    """The bytes of an array, all first bytes first: the shuffle's compression
    then removes the high bytes that small numbers share."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unplaned(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def steps(sorted_values: np.ndarray) -> bytes:
    """Sorted 32-bit values as the differences between neighbours."""
    return planes(np.diff(sorted_values, prepend=sorted_values.dtype.type(0)))


def summed(data: bytes) -> np.ndarray:
    return np.cumsum(unplaned(data, np.uint32), dtype=np.uint64)


#: kind 0: ``h`` are 32-bit hashes of index entries, with references to their rows;
#: kind 1: ``h`` are distinct 32-bit probe hashes, ``twice`` those seen twice in the slice.
PROBED = "p int, kind int, h binary, twice binary, id binary, sub binary, pos binary"


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit hashes, so that high bits are as good as low ones."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash modulo 2**64 of every ``n`` consecutive values; the last
    ``n - 1`` entries are incomplete."""
    def after(x, k):
        out = np.zeros_like(x)
        out[:max(0, len(x) - k)] = x[k:]
        return out
    base = 0x9E3779B97F4A7C15
    power, size, done, out = h, 1, 0, None
    factor = base
    while n:
        if n & 1:
            out = power if out is None else out * np.uint64(factor) + after(power, done)
            done += size
        n >>= 1
        if n:
            power = power * np.uint64(factor) + after(power, size)
            factor, size = factor * factor % (1 << 64), size * 2
    return out


def least_of(h: np.ndarray, n: int) -> np.ndarray:
    """The least of every ``n`` consecutive values (fewer at the end)."""
    size, out = 1, h
    while size < n:
        step = min(size, n - size)
        later = np.full_like(out, np.iinfo(out.dtype).max)
        later[:max(0, len(out) - step)] = out[step:]
        out = np.minimum(out, later)
        size += step
    return out


def _scaled(h: np.ndarray, n: int) -> tuple[np.ndarray, np.uint64]:
    """The hashes times ``n``, and how many bits of that are below the range's number."""
    lost = max(1, (n - 1).bit_length())
    return (h >> np.uint64(lost)) * np.uint64(n), np.uint64(64 - lost)


def ranges(h: np.ndarray, n: int) -> np.ndarray:
    """The hash range of each hash: monotonic in the hash."""
    scaled, bits = _scaled(h, n)
    return scaled >> bits


def within(h: np.ndarray, n: int) -> np.ndarray:
    """32 bits that order the hashes of a range."""
    scaled, bits = _scaled(h, n)
    return ((scaled & ((np.uint64(1) << bits) - np.uint64(1))) >> (bits - np.uint64(32))).astype(np.uint32)


def cut(sorted_hashes: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(range, start, end) of the filled hash ranges of sorted hashes."""
    p = ranges(sorted_hashes, n)
    at = np.searchsorted(p, np.arange(n + 1, dtype=np.uint64))
    return [(i, int(at[i]), int(at[i + 1])) for i in range(n) if at[i] < at[i + 1]]


def rows_of(batch):
    """The rows of an Arrow batch of blobs, one at a time as dicts."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        yield {c: batch.column(k)[i].as_py() for k, c in enumerate(names)}


def probe_blobs(index: np.ndarray, ids: np.ndarray, sub: np.ndarray, pos: np.ndarray,
                probes: np.ndarray, n: int, content: np.ndarray | None = None):
    """One Arrow batch of the blobs of a slice: index entries and probe hashes.
    ``content`` (32 bits an entry) goes into the entries' unused ``twice``."""
    import pyarrow as pa
    rows = []
    order = np.argsort(index)
    index, ids, sub, pos = index[order], ids[order], sub[order], pos[order]
    low = within(index, n)
    for p, s, e in cut(index, n):
        rows.append((p, 0, steps(low[s:e]), b"" if content is None else planes(content[order[s:e]]), planes(ids[s:e]), planes(sub[s:e]), planes(pos[s:e])))
    values, counts = np.unique(probes, return_counts=True)
    low = within(values, n)
    for p, s, e in cut(values, n):
        rows.append((p, 1, steps(low[s:e]), steps(low[s:e][counts[s:e] > 1]), b"", b"", b""))
    columns = list(zip(*rows, strict=True)) or [[]] * 7
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      names=["p", "kind", "h", "twice", "id", "sub", "pos"])


def per_row(ids: np.ndarray, sub: np.ndarray, values: np.ndarray, name: str):
    """One Arrow row per (id, sub) with its values packed as int32."""
    import pyarrow as pa
    order = np.lexsort((values, sub, ids))
    ids, sub, values = ids[order], sub[order], values[order].astype(np.int32)
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (sub[1:] != sub[:-1])
    edges = np.append(np.nonzero(new)[0], len(ids))
    packed = [values[s:e].tobytes() for s, e in zip(edges[:-1], edges[1:], strict=True)]
    starts = edges[:-1]
    return pa.RecordBatch.from_arrays([pa.array(ids[starts], pa.int64()), pa.array(sub[starts], pa.int64()),
                                       pa.array(packed, pa.binary())], names=["id", "sub", name])


#: Probe hashes that a task collects before it merges them.
MERGED = 1 << 22


class _Probed:
    """The hashes of one range that were probed at least twice."""

    def __init__(self):
        self.once, self.twice = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.parts, self.held = [], 0

    def add(self, distinct: np.ndarray, twice: np.ndarray) -> None:
        """The distinct probes of a slice, and those seen twice in it."""
        self.parts += [distinct, twice]  # a hash in both counts twice
        self.held += len(distinct) + len(twice)
        if self.held > MERGED:
            self.merge()

    def merge(self) -> None:
        values, counts = np.unique(np.concatenate([self.once, *self.parts]), return_counts=True)
        self.twice = np.union1d(self.twice, values[counts > 1])
        self.once = values  # all so far; one more probe of any makes two
        self.parts, self.held = [], 0

    def hits(self, h: np.ndarray) -> np.ndarray:
        if self.parts:
            self.merge()
        if not len(self.twice):
            return np.zeros(len(h), bool)
        return self.twice[np.minimum(np.searchsorted(self.twice, h), len(self.twice) - 1)] == h


def repeated(blobs: DataFrame, n: int, many: int | None = None) -> DataFrame:
    """``id, sub, found``: per row and hash range, the positions of the index
    entries whose hash was probed at least twice in the corpus (an entry's own
    probe counts once). 32 bits within a range may collide, so a hit is a
    candidate that the caller verifies; no repeat is missed. With ``many``,
    entries whose hash has more than that many contents go to a list ``hot``.

    One of ``n`` tasks works on one hash range at a time. It holds the range's probe
    hashes, which a hot hash is among once per slice; the index entries, which a hot
    hash has once per place, pass through (with ``many`` they are held, as the
    contents of a hash must be counted before any of its entries is told hot).
    """
    def entries(row):
        return (summed(row["h"]), unplaned(row["id"], np.int64), unplaned(row["sub"], np.int64),
                unplaned(row["pos"], np.int32))

    def passed(batches):
        open_p, probed = None, None
        for batch in batches:
            for row in rows_of(batch):
                if row["p"] != open_p:
                    open_p, probed = row["p"], _Probed()
                if row["kind"] == 1:  # these come first
                    probed.add(summed(row["h"]), summed(row["twice"]))
                    continue
                h, ids, sub, pos = entries(row)
                on = probed.hits(h)
                if on.any():
                    yield per_row(ids[on], sub[on], pos[on], "found")

    def parted(batches):
        open_p, probed, held = None, None, []
        for batch in batches:
            for row in rows_of(batch):
                if row["p"] != open_p:
                    yield from settled(held, probed)
                    open_p, probed, held = row["p"], _Probed(), []
                if row["kind"] == 1:
                    probed.add(summed(row["h"]), summed(row["twice"]))
                    continue
                h, ids, sub, pos = entries(row)
                on = probed.hits(h)
                if on.any():
                    held.append((h[on], ids[on], sub[on], pos[on], unplaned(row["twice"], np.uint32)[on]))
        yield from settled(held, probed)

    def settled(held, probed):
        import pyarrow as pa
        if not held:
            return
        keys = probed.twice
        pairs = [np.searchsorted(keys, x[0]).astype(np.uint64) << np.uint64(32) | x[4] for x in held]
        pairs = np.unique(np.concatenate(pairs)) >> np.uint64(32)
        hot = np.bincount(pairs.astype(np.int64), minlength=len(keys)) > many
        for h, ids, sub, pos, _ in held:
            is_hot = hot[np.searchsorted(keys, h)]
            for name, on in (("found", ~is_hot), ("hot", is_hot)):
                if on.any():
                    batch = per_row(ids[on], sub[on], pos[on], name)
                    none = pa.nulls(batch.num_rows, pa.binary())
                    both = [batch.column(2), none] if name == "found" else [none, batch.column(2)]
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *both], names=["id", "sub", "found", "hot"])

    ordered = blobs.repartition(n, "p").sortWithinPartitions("p", F.desc("kind"))
    if many is None:
        return ordered.mapInArrow(passed, "id long, sub long, found binary")
    return ordered.mapInArrow(parted, "id long, sub long, found binary, hot binary")


def gathered(lists: DataFrame, *names: str) -> DataFrame:
    """One row per (id, sub) with the arrays of its packed lists."""
    return lists.groupBy("id", "sub").agg(*(F.collect_list(name).alias(name) for name in names))


def unpacked(packed) -> np.ndarray:
    """The int32 values of a list of packed lists."""
    return np.concatenate([np.frombuffer(x, np.int32) for x in packed]) if packed else np.zeros(0, np.int32)


def marked(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of ``n`` places lie in one of the intervals [start, start + width)."""
    step = np.zeros(n + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + width, n), -1)
    return np.cumsum(step[:n]) > 0
