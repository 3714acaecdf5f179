"""Substring dedup by fixed-block anchors.

A window is ``WINDOW`` consecutive words of one document; each holds a whole
aligned block of ``BLOCK`` words, as ``WINDOW >= 2 * BLOCK - 1``.

1. Anchors: every document's non-overlapping blocks are the index; every rolling
   block-sized window of the corpus probes it. A block met at one place only
   cannot lie in a repeated window. Probes are packed per slice and hash range.
2. Extension: runs of hit blocks widen to every window whose blocks were all
   hit. Window sequences, identified by two rolling hashes of words hashed under
   two seeds (128 bits), meet in hash ranges, where each but the first (by
   doc_id, then start) is marked. A slice sends only its first document's
   occurrence of a sequence; the others are marked where they are, so a hot
   passage is pre-aggregated. A window goes where its least word says; a range
   with far more windows than the mean is split by the windows' own hashes.
   Consecutive marked windows of a document form its maximal repeats.
3. The words under marked windows are removed.

Defined cases: a null or empty text has no words; a null doc_id comes after all
others; rows that share a doc_id do not remove each other's words (neither is
earlier) but each removes its own inner repeats; repeated rows are handled once
and share the verdict; an empty table gives no rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cadenza.llm import blobs
from cadenza.llm.common import as_bytes, checkpoint_ready, named, partitions, spread_lists, sub_hash, table, text_chunks, with_lists

WINDOW, BLOCK = 20, 10


def word_hashes(texts: list[bytes], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the offset of each text's first."""
    from xxhash import xxh3_64_intdigest
    hashed = partial(xxh3_64_intdigest, seed=seed) if seed else xxh3_64_intdigest
    counts, hashes = [], []
    for t in texts:
        words = t.split()
        counts.append(len(words))
        hashes.append(np.fromiter(map(hashed, words), np.uint64, len(words)))
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), offsets


def _anchor_blobs(docs: DataFrame, block: int, n: int) -> DataFrame:
    """Index entries and probes of the blocks, in ``n`` hash ranges."""
    def run(batches):
        for chunk in text_chunks(batches, 4 << 20):
            h, offsets = word_hashes(as_bytes(chunk.column("text")))
            if not len(h):
                continue
            sizes = np.diff(offsets)
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(h)) - offsets[row]
            whole = place + block <= sizes[row]
            rolling = blobs.mixed(blobs.rolled(h, block))
            at = np.nonzero(whole & (place % block == 0))[0]
            ids = chunk.column("id").to_numpy()
            sub = chunk.column("sub").to_numpy()
            yield blobs.probe_blobs(rolling[at], ids[row[at]], sub[row[at]],
                                    (place[at] // block).astype(np.int32), rolling[whole], n)

    return docs.select("id", "sub", "text").mapInArrow(run, blobs.PROBED)


#: Occurrences of windows, by stretches of consecutive starts in one row: ``id``,
#: ``sub``, ``start`` and ``size`` per stretch, ``h1`` and ``h2`` per window.
#: kind 0: to compare; kind 1 (no hashes): a slice has marked them itself.
_OCCURRENCES = "p int, kind int, h1 binary, h2 binary, id binary, sub binary, start binary, size binary"


def _stretches(p, kind, a, b, ids, sub, pos, row, n):
    """Rows of _OCCURRENCES for windows sorted by (row, pos)."""
    order = np.argsort(p, kind="stable")
    p, a, b, ids, sub, pos, row = (x[order] for x in (p, a, b, ids, sub, pos, row))
    new = np.ones(len(p), dtype=bool)
    new[1:] = (p[1:] != p[:-1]) | (row[1:] != row[:-1]) | (pos[1:] != pos[:-1] + 1)
    first = np.nonzero(new)[0]
    size = np.diff(np.append(first, len(p))).astype(np.int32)
    at = np.searchsorted(p, np.arange(n + 1, dtype=p.dtype))
    at_first = np.searchsorted(first, at)
    for i in np.nonzero(np.diff(at))[0]:
        s, e, f = at[i], at[i + 1], slice(at_first[i], at_first[i + 1])
        hashes = (a[s:e].tobytes(), b[s:e].tobytes()) if kind == 0 else (b"", b"")
        lead = first[f]
        yield (int(i), kind, *hashes, *(blobs.planes(x) for x in (ids[lead], sub[lead], pos[lead], size[f])))


def _read_stretches(row):
    """(id, sub, pos) per window."""
    ids, sub, start, size = (blobs.unplaned(row[k], t) for k, t in (
        ("id", np.int64), ("sub", np.int64), ("start", np.int32), ("size", np.int32)))
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(ids, size), np.repeat(sub, size), (np.repeat(start, size) + inner).astype(np.int32)


def _windows(h, offsets, found, window: int, block: int):
    """(place, row) of the windows whose whole blocks were all hit. ``found`` has
    the packed lists of hit blocks of each row."""
    places, rows = [], []
    for r, packed in enumerate(found):
        size = int(offsets[r + 1] - offsets[r])
        on = np.zeros(size // block + 2, dtype=bool)
        on[blobs.unpacked(packed)] = True
        start = np.arange(max(0, size - window + 1))
        # the whole blocks inside [start, start + window)
        b, last = -(-start // block), (start + window) // block
        total = np.concatenate([[0], np.cumsum(on)])
        start = start[total[last] - total[b] == last - b]
        places.append(start + offsets[r])
        rows.append(np.full(len(start), r))
    return np.concatenate(places), np.concatenate(rows)


def _least_range(h, at, window: int, n: int):
    """A window goes where its least word hash says: equal windows meet, and most
    neighbours go together."""
    return blobs.ranges(blobs.mixed(blobs.least_of(h, window)[at]), n)


#: A range with so many times the mean of its windows is split.
SPLIT = 4
#: One document in so many, by a hash of its id, shows which ranges are hot. Only
#: the layout of the exchange depends on it.
SHOWN = 16


def _hot_ranges(texts: DataFrame, hits: DataFrame, window: int, block: int, n: int) -> np.ndarray:
    """The hash ranges that hold more than ``SPLIT`` times the mean number of
    windows: a frequent word is the least of many windows, and the windows that
    straddle an end of a frequent passage share its least word but not their
    flanks. At most ``n / SPLIT`` numbers come to the driver."""
    def run(batches):
        import pyarrow as pa
        counts = np.zeros(n, np.int64)
        for chunk in text_chunks(batches):
            h, offsets = word_hashes(as_bytes(chunk.column("text")))
            at, _ = _windows(h, offsets, chunk.column("found").to_pylist(), window, block)
            counts += np.bincount(_least_range(h, at, window, n).astype(np.int64), minlength=n)
        on = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(on.astype(np.int32)), pa.array(counts[on])], names=["p", "n"])

    shown = F.pmod(F.xxhash64("id"), F.lit(SHOWN)) == 0
    counts = (with_lists(texts.where(shown), hits.where(shown), "inner").mapInArrow(run, "p int, n long")
              .groupBy("p").agg(F.sum("n").alias("n")).checkpoint())
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where((F.col("n") > SPLIT * total / n) & (F.col("n") >= 64))
    return np.array(sorted(r["p"] for r in hot.collect()), dtype=np.uint64)


def _window_blobs(hit: DataFrame, window: int, block: int, n: int, hot: np.ndarray) -> DataFrame:
    """Windows by hash range: those of ``hot`` ranges by their own hash."""
    def run(batches):
        import pyarrow as pa
        for chunk in text_chunks(batches):
            texts = as_bytes(chunk.column("text"))
            h, offsets = word_hashes(texts)
            at, row = _windows(h, offsets, chunk.column("found").to_pylist(), window, block)
            if not len(at):
                continue
            p = _least_range(h, at, window, n)
            a = blobs.mixed(blobs.rolled(h, window)[at])
            b = blobs.rolled(word_hashes(texts, seed=1)[0], window)[at]
            split = np.isin(p, hot)
            p[split] = blobs.ranges(a[split], n)
            pos = (at - offsets[row]).astype(np.int32)
            ids, sub = chunk.column("id").to_numpy()[row], chunk.column("sub").to_numpy()[row]
            order = np.lexsort((pos, row, ids, b, a))
            same = np.zeros(len(a), dtype=bool)  # as the one before
            same[1:] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
            lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(a))))
            later = ids[order] != ids[order][lead]
            later[1:] |= same[1:] & (row[order][1:] == row[order][:-1])
            late = np.zeros(len(a), dtype=bool)
            late[order] = later
            # settled windows need not meet others: those of a document stay together
            p[late] = blobs.ranges(blobs.mixed((ids[late] ^ sub[late]).view(np.uint64)), n)
            out = []
            for kind, on in ((0, ~late), (1, late)):
                out += _stretches(*([p[on], kind] + [v[on] for v in (a, b, ids, sub, pos, row)]), n)
            types = [pa.int32(), pa.int32()] + [pa.binary()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                names=["p", "kind", "h1", "h2", "id", "sub", "start", "size"])

    return hit.mapInArrow(run, _OCCURRENCES)


#: Window starts of many rows, by ranges of the rows' names.
_STARTS = "q int, id binary, sub binary, pos binary"


def _packed_starts(ids, sub, pos, n):
    """One Arrow batch of _STARTS."""
    import pyarrow as pa
    q = blobs.ranges(blobs.mixed((ids ^ sub).view(np.uint64)), n).astype(np.int64)
    order = np.lexsort((pos, sub, ids, q))
    q, ids, sub, pos = q[order], ids[order], sub[order], pos[order]
    edges = np.append(np.flatnonzero(np.diff(q, prepend=-1)), len(q))
    cells = [[blobs.planes(x[s:e]) for s, e in zip(edges[:-1], edges[1:], strict=True)] for x in (ids, sub, pos)]
    return pa.RecordBatch.from_arrays([pa.array(q[edges[:-1]], pa.int32()), *(pa.array(c, pa.binary()) for c in cells)],
                                      names=["q", "id", "sub", "pos"])


def _later(occurrences: DataFrame, n: int) -> DataFrame:
    """``id, sub, late``: per row the window starts whose sequence starts in a
    smaller doc_id, and those that a slice has marked itself."""
    ranges = n * blobs.SPREAD

    def settle(rows):
        a, b = (np.concatenate([np.frombuffer(r[k], np.uint64) for r in rows]) for k in ("h1", "h2"))
        ids, sub, pos = (np.concatenate(x) for x in zip(*map(_read_stretches, rows), strict=True))
        order = np.lexsort((ids, b, a))
        a, b, ids, sub, pos = (x[order] for x in (a, b, ids, sub, pos))
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
        late = ids != ids[lead]
        return ids[late], sub[late], pos[late]

    def run(batches):
        open_p, rows, done = None, [], []

        def flush():
            if rows:
                done.append(settle(rows))
                rows.clear()

        def out():
            found = [np.concatenate(x) for x in zip(*done, strict=True)]
            done.clear()
            if len(found[0]):
                yield _packed_starts(*found, ranges)

        for batch in batches:
            for row in blobs.rows_of(batch):
                if row["p"] != open_p:
                    flush()
                    open_p = row["p"]
                if row["kind"] == 0:
                    rows.append(row)
                else:
                    done.append(_read_stretches(row))
                if sum(len(x[0]) for x in done) > 1 << 20:
                    yield from out()
        flush()
        if done:
            yield from out()

    def by_row(batches):
        open_q, held = None, []

        def out():
            found = [np.concatenate(x) for x in zip(*held, strict=True)]
            held.clear()
            yield blobs.per_row(*found, "late")

        for batch in batches:
            for row in blobs.rows_of(batch):
                if held and row["q"] != open_q:
                    yield from out()
                open_q = row["q"]
                held.append([blobs.unplaned(row[k], t) for k, t in (("id", np.int64), ("sub", np.int64), ("pos", np.int32))])
        if held:
            yield from out()

    packed = occurrences.repartition(n, "p").sortWithinPartitions("p", "kind").mapInArrow(run, _STARTS)
    return packed.repartition(n, "q").sortWithinPartitions("q").mapInArrow(by_row, "id long, sub long, late binary")


def substring_dedup(docs: DataFrame, window: int = WINDOW, block: int | None = None,
                    carry: bool = False, sub=sub_hash) -> DataFrame:
    """``doc_id, text, n_words, n_removed, n_spans``: ``text`` is the kept words
    joined by one space, ``n_spans`` counts the maximal removed runs. With
    ``carry``, a struct ``rest`` of the other columns of ``docs`` too."""
    block = block or (window + 1) // 2
    if block < 1 or window < 2 * block - 1:
        raise ValueError("a window must hold a whole aligned block")
    checkpoint_ready(docs.sparkSession)
    texts = named(docs, carry, sub)
    rest = [f for f in texts.rows.schema.fields if f.name == "rest"]
    n = partitions(docs)
    ranges = n * blobs.SPREAD
    hits = blobs.gathered(blobs.repeated(_anchor_blobs(texts.unique, block, ranges), n), "found").checkpoint()
    hit = with_lists(texts.unique, hits, "inner")
    hot = _hot_ranges(texts.unique, hits, window, block, ranges)
    late = _later(_window_blobs(hit, window, block, ranges, hot), n)

    def run(batches):
        import pyarrow as pa
        for chunk in text_chunks(batches):
            kept, n_words, n_removed, n_spans = [], [], [], []
            for text, packed in zip(as_bytes(chunk.column("text")), chunk.column("late").to_pylist(), strict=True):
                words = text.split()
                off = blobs.marked(len(words), blobs.unpacked([packed] if packed else []), window)
                n_words.append(len(words))
                n_removed.append(int(off.sum()))
                n_spans.append(int(off[:1].sum() + (off[1:] & ~off[:-1]).sum()))
                if n_removed[-1]:
                    words = [w for w, o in zip(words, off.tolist(), strict=True) if not o]
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                 *(chunk.column(f.name) for f in rest)],
                names=["doc_id", "text", "n_words", "n_removed", "n_spans", *(f.name for f in rest)])

    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                         *(StructField(c, LongType()) for c in ("n_words", "n_removed", "n_spans")), *rest])
    return spread_lists(texts, late).mapInArrow(run, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with the repeated words removed from
    ``text`` (``n_chars``, where there is such a column, is the new length)."""
    done = substring_dedup(docs, carry=True)
    columns = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length("text")
    return done.select(*(columns.get(c, F.col(f"rest.`{c}`")).cast(docs.schema[c].dataType).alias(c)
                         for c in docs.columns))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"), "n_spans")
