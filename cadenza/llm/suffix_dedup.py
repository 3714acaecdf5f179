"""Suffix-array dedup: longest-previous-factor arrays over repeated regions.

Texts are UTF-8 bytes; a factor is ``width`` bytes of one document.

1. Winnowing: of the ``GRAM``-byte hashes in a factor the least is its anchor,
   so equal factors have equal anchors. Consecutive factors with one anchor form
   a segment, and each document's segment anchors meet in packed hash ranges.
   A segment whose anchor occurs once in the corpus holds no repeat.
2. The other segments' bytes go where their anchor says, so that all places of
   a repeated factor are in one bucket. Identical segments are merged, first per
   slice: a hot passage sends its bytes once per slice.
3. A suffix array (prefix doubling, in numpy, over slices of whole buckets) puts
   equal factors next to each other. In suffix order the previous and the next
   smaller position that share ``width`` bytes give the earlier match of a
   longest-previous-factor array; the previous and next larger ones the later.
4. An anchor with more distinct segments than fill a slice (a passage that very
   many documents share has other flanks in each) is no bucket: its factors go
   one by one where their own hash says, first as hashes, then, if met twice,
   with their bytes. Equal factors meet, different flanks part.
5. ``keep="first"`` removes factors with an earlier match, so the first copy
   stays; ``keep="none"`` also those with a later match, so no copy stays.

Earlier means a smaller doc_id, or an earlier byte of the same document.
Defined cases: a null or empty text has no factors; a null doc_id comes last;
rows that share a doc_id are separate documents whose order is that of their
texts' hashes; of repeated rows one is the first; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import blobs
from cadenza.llm.common import as_bytes, checkpoint_ready, named, partitions, sub_hash, table, text_chunks, with_lists

WIDTH = 200
#: Bytes of an anchor; a factor holds ``width - GRAM + 1`` of them.
GRAM = 64
#: Bytes of text in a suffix array.
SLICE = 1 << 20


def _symbols() -> np.ndarray:
    return blobs.mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def segments(texts: list[bytes], width: int, gram: int):
    """(row, start, size, hash) of the segments of texts, by row and start, and
    all anchor hashes, those of thinned ties included. ``size`` counts factors."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if not len(text) or sizes.max() < width:
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    ends = np.cumsum(sizes)
    left = (np.repeat(ends, sizes) - np.arange(len(text))).astype(np.int32)
    h = blobs.mixed(blobs.rolled(_symbols()[text], gram))
    bits = np.uint64(max(1, len(text).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    key = (h & ~low) | np.arange(len(text), dtype=np.uint64)
    key[left < gram] = np.iinfo(np.uint64).max
    span = width - gram + 1
    least = blobs.least_of(key, span)
    p = np.nonzero(left >= width)[0]  # factor starts
    anchor = (least[p] & low).astype(np.int64)
    del key, least
    chosen, place = np.unique(anchor, return_inverse=True)
    everything = h[chosen]
    # of equal anchors close together (periodic text) keep enough that each
    # factor still holds one
    tied = (everything[1:] == everything[:-1]) & (np.diff(chosen) <= span)
    tied &= left[chosen[:-1]] > np.diff(chosen)
    if tied.any():
        keep = np.ones(len(chosen), dtype=bool)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], tied.view(np.int8), [0]])))
        for first, last in zip(edge[::2], edge[1::2], strict=True):
            keep[first + 1:last] = False
            at = first
            while at < last:
                at = min(max(at + 1, int(np.searchsorted(chosen[first:last + 1], chosen[at] + span, "right")) - 1 + first), last)
                keep[at] = True
        index = np.arange(len(chosen))
        after = np.minimum.accumulate(np.where(keep, index, len(chosen))[::-1])[::-1]
        before = np.maximum.accumulate(np.where(keep, index, 0))
        later = chosen[after[place]]
        anchor = np.where(later <= p + span - 1, later, chosen[before[place]])
    new = np.ones(len(p), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.nonzero(new)[0]
    size = np.diff(np.append(first, len(p)))
    row = np.searchsorted(ends, p[first], "right")
    # anchors are the least hashes around them: mixed again they fill all hash ranges
    again = lambda x: blobs.mixed(x ^ np.uint64(0x2545F4914F6CDD1D))
    return row, p[first] - (ends - sizes)[row], size, again(h[anchor[first]]), again(everything)


def ordinals(row: np.ndarray) -> np.ndarray:
    """Number of each segment within its (sorted) row."""
    return np.arange(len(row)) - np.searchsorted(row, row)


def factor_hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of ``width`` bytes from each place of the joined texts, and where each text starts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text = np.frombuffer(b"".join(texts), np.uint8)
    return blobs.mixed(blobs.rolled(_symbols()[text], width)), np.cumsum(sizes) - sizes


def contents(texts: list[bytes], row: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """32 bits of each segment's bytes: its first and last factor cover it."""
    h, offset = factor_hashes(texts, width)
    at = offset[row] + start
    both = h[at] * np.uint64(0x9E3779B97F4A7C15) + h[at + size - 1] + size.astype(np.uint64)
    return (blobs.mixed(both) >> np.uint64(32)).astype(np.uint32)


def _anchor_blobs(docs: DataFrame, width: int, gram: int, n: int) -> DataFrame:
    def run(batches):
        for chunk in text_chunks(batches, 1 << 20):
            texts = as_bytes(chunk.column("text"))
            row, start, size, h, everything = segments(texts, width, gram)
            if len(row):
                ids, sub = (chunk.column(c).to_numpy()[row] for c in ("id", "sub"))
                # a segment's own anchor counts once per segment, a thinned one once more
                probes = np.concatenate([h, np.setdiff1d(everything, h)])
                extra = len(everything) - len(np.unique(everything))
                if extra:
                    values, counts = np.unique(everything, return_counts=True)
                    probes = np.concatenate([probes, values[counts > 1]])
                yield blobs.probe_blobs(h, ids, sub, ordinals(row).astype(np.int32), probes, n,
                                        contents(texts, row, start, size, width))

    return docs.select("id", "sub", "text").mapInArrow(run, blobs.PROBED)


#: kind 0: segments with their bytes; kind 1: stretches of matched factors that a
#: slice has settled itself (no hashes, no bytes); kind 2: factors of hot anchors with their bytes.
_SEGMENTS = "p int, kind int, h binary, size binary, text binary, id binary, sub binary, start binary"


def _segment_blobs(hit: DataFrame, width: int, gram: int, keep_first: bool, n: int) -> DataFrame:
    """Segments by hash range. Of identical segments in a slice the first is sent;
    the others, and with ``keep_first`` off the first too, are matched throughout."""
    def run(batches):
        import pyarrow as pa
        for chunk in text_chunks(batches, 1 << 20):
            texts = as_bytes(chunk.column("text"))
            row, start, size, h, _ = segments(texts, width, gram)
            if not len(row):
                continue
            on = np.zeros(len(row), dtype=bool)
            first = np.searchsorted(row, np.arange(len(texts)))
            for r, packed in enumerate(chunk.column("found").to_pylist()):
                on[first[r] + blobs.unpacked(packed)] = True
            row, start, size, h = (x[on] for x in (row, start, size, h))
            ids, sub = (chunk.column(c).to_numpy()[row] for c in ("id", "sub"))
            order = np.lexsort((start, sub, ids, h))  # by hash, then document order
            row, start, size, h, ids, sub = (x[order] for x in (row, start, size, h, ids, sub))
            start, size = start.astype(np.int32), size.astype(np.int32)
            out = []
            for p, s, e in blobs.cut(h, n):
                first: dict[bytes, int] = {}
                settled = set()
                for i, r, a, k in zip(range(s, e), row[s:e].tolist(), start[s:e].tolist(), size[s:e].tolist(), strict=True):
                    lead = first.setdefault(texts[r][a:a + k + width - 1], i)
                    if lead != i:
                        settled.add(i)
                        if not keep_first:
                            settled.add(lead)
                for kind, at, sent in ((0, list(first.values()), True), (1, sorted(settled), False)):
                    if at:
                        refs = [blobs.planes(x[at]) for x in (size, ids, sub, start)]
                        out.append((p, kind, h[at].tobytes() if sent else b"", refs[0],
                                    b"".join(first) if sent else b"", *refs[1:]))
            if out:
                types = [pa.int32(), pa.int32()] + [pa.binary()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names=[c.split()[0] for c in _SEGMENTS.split(", ")])

    return hit.mapInArrow(run, _SEGMENTS)


def _hot_factor_blobs(hit: DataFrame, width: int, gram: int, n: int) -> DataFrame:
    """Index entries and probes of the factors in the segments listed by ``hot``."""
    def run(batches):
        for chunk in text_chunks(batches, 1 << 20):
            texts = as_bytes(chunk.column("text"))
            row, start, size, _, _ = segments(texts, width, gram)
            on = np.zeros(len(row), dtype=bool)
            first = np.searchsorted(row, np.arange(len(texts)))
            for r, packed in enumerate(chunk.column("hot").to_pylist()):
                on[first[r] + blobs.unpacked(packed)] = True
            row, start, size = (x[on] for x in (row, start, size))
            if not len(row):
                continue
            h, offset = factor_hashes(texts, width)
            at = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            row = np.repeat(row, size)
            h = h[offset[row] + at]
            ids, sub = (chunk.column(c).to_numpy()[row] for c in ("id", "sub"))
            yield blobs.probe_blobs(h, ids, sub, at.astype(np.int32), h, n)

    return hit.select("id", "sub", "text", "hot").mapInArrow(run, blobs.PROBED)


def _factor_blobs(hit: DataFrame, width: int, keep_first: bool, n: int) -> DataFrame:
    """The factors at the starts ``found``, by hash range, merged per slice like segments."""
    def run(batches):
        import pyarrow as pa
        for chunk in text_chunks(batches, 1 << 20):
            texts = as_bytes(chunk.column("text"))
            starts = [np.unique(blobs.unpacked(x)) for x in chunk.column("found").to_pylist()]
            row = np.repeat(np.arange(len(texts)), list(map(len, starts)))
            start = np.concatenate(starts)
            h, offset = factor_hashes(texts, width)
            h = h[offset[row] + start]
            ids, sub = (chunk.column(c).to_numpy()[row] for c in ("id", "sub"))
            order = np.lexsort((start, sub, ids, h))
            row, start, h, ids, sub = (x[order] for x in (row, start, h, ids, sub))
            size = np.ones(len(row), np.int32)
            out = []
            for p, s, e in blobs.cut(h, n):
                first: dict[bytes, int] = {}
                settled = set()
                for i, r, a in zip(range(s, e), row[s:e].tolist(), start[s:e].tolist(), strict=True):
                    lead = first.setdefault(texts[r][a:a + width], i)
                    if lead != i:
                        settled.add(i)
                        if not keep_first:
                            settled.add(lead)
                for kind, at, text in ((2, list(first.values()), b"".join(first)), (1, sorted(settled), b"")):
                    if at:
                        refs = [blobs.planes(x[at]) for x in (size, ids, sub, start)]
                        out.append((p, kind, b"", refs[0], text, *refs[1:]))
            if out:
                types = [pa.int32(), pa.int32()] + [pa.binary()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names=[c.split()[0] for c in _SEGMENTS.split(", ")])

    return hit.select("id", "sub", "text", "found").mapInArrow(run, _SEGMENTS)


def ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of the keys."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    out = np.empty(len(keys), np.int32)
    out[order] = np.cumsum(new, dtype=np.int32)
    return out


def factor_matches(text: bytes, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For factor starts in a text: has the factor an earlier, and a later, match
    among the starts? From the suffix order to depth ``width``."""
    data = np.frombuffer(text + bytes(2 * width + 16), np.uint8)
    n = len(text)
    key = np.zeros(n + width, np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | data[j:j + n + width]
    depth, rank = 8, ranks(key)
    del key
    levels = [(8, rank)]
    while 2 * depth <= width:
        after = np.zeros_like(rank)
        after[:-depth] = rank[depth:]
        rank = ranks(rank.astype(np.int64) << np.int64(32) | after)
        depth *= 2
        levels.append((depth, rank))
    # the factor is covered by blocks of the depths reached; the last may overlap
    name, done = levels[-1][1][starts], depth
    while done < width:
        size, rank = next((d, r) for d, r in reversed(levels) if d <= max(8, width - done))
        at = min(done, width - size) if width >= size else done
        name = ranks(name.astype(np.int64) << np.int64(32) | rank[starts + at])
        done = at + size
    order = np.lexsort((starts, name))  # suffix order to this depth, ties by position
    position, run = starts[order], name[order]
    smaller_before, larger_before = _nearest(position, run)
    larger_after, smaller_after = (x[::-1] for x in _nearest(-position[::-1], run[::-1]))
    earlier, later = np.empty(len(starts), bool), np.empty(len(starts), bool)
    earlier[order] = smaller_before | smaller_after
    later[order] = larger_before | larger_after
    return earlier, later


def _nearest(position: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Is there a smaller, and a larger, position before each one in its run?"""
    new = np.ones(len(run), dtype=bool)
    new[1:] = run[1:] != run[:-1]
    index = np.cumsum(new)
    far = int(np.abs(position).max(initial=0)) * 2 + 2
    low = np.minimum.accumulate(position - index * far) + index * far
    high = np.maximum.accumulate(position + index * far) - index * far
    smaller, larger = np.zeros(len(run), bool), np.zeros(len(run), bool)
    smaller[1:] = ~new[1:] & (low[:-1] < position[1:])
    larger[1:] = ~new[1:] & (high[:-1] > position[1:])
    return smaller, larger


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of the runs of set flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edge[::2], edge[1::2] - edge[::2]


_REFS = (("id", np.int64), ("sub", np.int64), ("start", np.int32), ("size", np.int32))


class Buckets:
    """Matches of the segments of one hash range."""

    def __init__(self, width: int, first: bool):
        self.width, self.first = width, first
        self.out: list[tuple[int, int, int, int]] = []  # id, sub, start, size

    def settle(self, rows: list[dict]) -> None:
        for r in rows:
            if r["kind"] == 1:
                self.out.extend(zip(*(blobs.unplaned(r[c], k).tolist() for c, k in _REFS), strict=True))
        self.settle_factors([r for r in rows if r["kind"] == 2])
        rows = [r for r in rows if r["kind"] == 0]
        if not rows:
            return
        hashes = np.concatenate([np.frombuffer(r["h"], np.uint64) for r in rows])
        ids, sub, start, size = (np.concatenate([blobs.unplaned(r[c], k) for r in rows]) for c, k in _REFS)
        text = b"".join(r["text"] for r in rows)
        length = size.astype(np.int64) + self.width - 1
        at = np.cumsum(length) - length
        order = np.lexsort((start, sub, ids, hashes))
        new = np.ones(len(order), dtype=bool)
        new[1:] = hashes[order[1:]] != hashes[order[:-1]]
        edges = np.append(np.nonzero(new)[0], len(order)).tolist()
        refs = list(zip(ids.tolist(), sub.tolist(), start.tolist(), size.tolist(), strict=True))
        at, length, order = at.tolist(), length.tolist(), order.tolist()
        held: list[tuple[bytes, list]] = []
        total = 0
        for s, e in zip(edges, edges[1:], strict=False):
            variants: dict[bytes, list] = {}
            for i in order[s:e]:  # by document and start
                variants.setdefault(text[at[i]:at[i] + length[i]], []).append(refs[i])
            if len(variants) == 1 and e - s > 1 and not self.first:
                self.out.extend(refs[i] for i in order[s:e])
                continue
            held.extend(variants.items())
            total += sum(map(len, variants))
            if total > SLICE:
                self.flush(held)
                held, total = [], 0
        self.flush(held)

    def settle_factors(self, rows: list[dict]) -> None:
        """Factors alone: equal bytes are a match."""
        places: dict[bytes, list] = {}
        for r in rows:
            refs = zip(*(blobs.unplaned(r[c], k).tolist() for c, k in _REFS), strict=True)
            for i, ref in enumerate(refs):
                places.setdefault(r["text"][i * self.width:(i + 1) * self.width], []).append(ref)
        for copies in places.values():
            if len(copies) > 1:
                self.out.extend(sorted(copies)[1:] if self.first else copies)

    def flush(self, held: list[tuple[bytes, list]]) -> None:
        """Matches in the segments of whole buckets (variants in order of their first copies)."""
        if not held:
            return
        # text order is document order, across buckets too
        held = sorted(held, key=lambda v: v[1][0])
        sizes = np.array([len(v) for v, _ in held])
        offsets = np.cumsum(sizes) - sizes
        counts = sizes - self.width + 1
        owner = np.repeat(np.arange(len(held)), counts)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        earlier, later = factor_matches(b"".join(v for v, _ in held), offsets[owner] + inner, self.width)
        flags = earlier if self.first else earlier | later
        ends = np.cumsum(counts)
        for k, (_, copies) in enumerate(held):
            whole = (copies[0][2], copies[0][3])
            if len(copies) > 1:
                self.out.extend(copies[1:] if self.first else copies)
                if not self.first:
                    continue
            for a, n in zip(*_stretches(flags[ends[k] - counts[k]:ends[k]]), strict=True):
                self.out.append((copies[0][0], copies[0][1], whole[0] + int(a), int(n)))


def _matches(blobs_df: DataFrame, width: int, first: bool, n: int) -> DataFrame:
    """``id, sub, hits``: packed (start, size) stretches of matched factors."""
    def run(batches):
        import pyarrow as pa
        open_p, rows = None, []

        def done():
            buckets = Buckets(width, first)
            buckets.settle(rows)
            rows.clear()
            found = sorted(buckets.out)
            if not found:
                return None
            x = np.array(found, dtype=np.int64)
            new = np.ones(len(x), dtype=bool)
            new[1:] = (x[1:, :2] != x[:-1, :2]).any(axis=1)
            starts = np.nonzero(new)[0]
            pairs = x[:, 2:].astype(np.int32)
            packed = [pairs[s:e].tobytes() for s, e in zip(starts, np.append(starts[1:], len(x)), strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(x[starts, 0]), pa.array(x[starts, 1]), pa.array(packed, pa.binary())],
                names=["id", "sub", "hits"])

        for batch in batches:
            for row in blobs.rows_of(batch):
                if row["p"] != open_p:
                    if rows and (out := done()):
                        yield out
                    open_p = row["p"]
                rows.append(row)
        if rows and (out := done()):
            yield out

    return (blobs_df.repartition(n, "p").sortWithinPartitions("p")
            .mapInArrow(run, "id long, sub long, hits binary"))


def _sent(texts: DataFrame, width: int, gram: int, keep_first: bool, many: int, n: int) -> DataFrame:
    """Segments, and the factors of hot anchors, by hash range."""
    checkpoint_ready(texts.sparkSession)
    ranges = n * blobs.SPREAD
    lists = blobs.gathered(blobs.repeated(_anchor_blobs(texts, width, gram, ranges), n, many), "found", "hot").checkpoint()
    found, hot = (lists.where(F.size(c) > 0).select("id", "sub", c) for c in ("found", "hot"))
    sent = _segment_blobs(with_lists(texts, found, "inner"), width, gram, keep_first, ranges)
    if hot.isEmpty():
        return sent
    met = blobs.repeated(_hot_factor_blobs(with_lists(texts, hot, "inner"), width, gram, ranges), n)
    met = with_lists(texts, blobs.gathered(met, "found"), "inner")
    return sent.union(_factor_blobs(met, width, keep_first, ranges))


#: Repeated rows that one row of the result is multiplied to in one step.
COPIES = 1000


def _with_copies(unique: DataFrame, copies: DataFrame) -> DataFrame:
    """``unique`` with ``copies``, the rows it stands for; a row that stands for
    very many is spread, the first of them marked ``lead``."""
    counted = unique.join(copies.hint("shuffle_hash"), ["id", "sub"])
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES).cast("long"))
    split = counted.withColumn("part", F.explode(parts))
    left = F.least(F.col("copies") - F.col("part") * COPIES, F.lit(COPIES))
    split = split.withColumn("n", left).withColumn("lead", F.col("part") == 0)
    return split.repartition("id", "sub", "part")


def suffix_dedup(docs: DataFrame, width: int = WIDTH, keep: str = "first", many: int | None = None,
                 sub=sub_hash) -> DataFrame:
    """``doc_id, kept, n_bytes, n_removed, n_spans``: ``kept`` is the remaining bytes.

    An anchor with more than ``many`` distinct segments is hot; as many as fill
    a slice if not given. The result does not depend on it.
    """
    if keep not in ("first", "none"):
        raise ValueError("keep must be 'first' or 'none'")
    if width < 16:
        raise ValueError("width must be at least 16")
    gram = min(GRAM, width // 2)
    texts = named(docs, sub=sub)
    n = partitions(docs)
    many = SLICE // (2 * width) if many is None else many
    sent = _sent(texts.unique, width, gram, keep == "first", many, n)
    hits = blobs.gathered(_matches(sent, width, keep == "first", n), "hits")
    done = with_lists(texts.unique, hits, "left")
    if texts.copies is None:
        done = done.withColumn("copies", F.lit(1)).withColumn("n", F.lit(1)).withColumn("lead", F.lit(True))
    else:
        done = _with_copies(done, texts.copies)

    def run(batches):
        import pyarrow as pa
        for chunk in text_chunks(batches):
            ids, out = [], []
            columns = [chunk.column(c).to_pylist() for c in ("doc_id", "hits", "copies", "n", "lead")]
            for text, doc_id, packed, copies, n, lead in zip(as_bytes(chunk.column("text")), *columns, strict=True):
                pairs = blobs.unpacked(packed).reshape(-1, 2).astype(np.int64)
                row = (text, len(text), 0, 0)
                again = (b"", len(text), len(text), 1) if len(text) >= width else row  # a repeated row
                if copies > 1 and (keep == "none" or not lead):
                    row = again
                elif len(pairs):
                    step = np.zeros(len(text) + 1, np.int64)
                    np.add.at(step, pairs[:, 0], 1)
                    np.add.at(step, pairs[:, 0] + pairs[:, 1] + width - 1, -1)
                    off = np.cumsum(step[:-1]) > 0
                    row = (np.frombuffer(text, np.uint8)[~off].tobytes(), len(text), int(off.sum()), len(_stretches(off)[0]))
                for i in range(n):
                    ids.append(doc_id)
                    out.append(again if i else row)
                    if len(out) >= COPIES:
                        yield _result(pa, ids, out)
                        ids, out = [], []
            if out:
                yield _result(pa, ids, out)

    def _result(pa, ids, out):
        kept, *counts = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(kept, pa.binary()), *(pa.array(c, pa.int64()) for c in counts)],
            names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return done.select("doc_id", "text", "hits", "copies", "n", "lead").mapInArrow(
        run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), keep="none").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
