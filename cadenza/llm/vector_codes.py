"""Vector code compression by product quantisation, in integers throughout.

A component x becomes floor(1024 x); a vector is cut into ``PARTS`` equal parts,
and each part position has a codebook of ``ENTRIES`` entries that ``ROUNDS`` of
nearest-entry assignment and componentwise floored means improve.

Nearest entries come from an integer Walsh-Hadamard transform. Parts and entries
are padded with zeros to a power of two m and transformed; squared differences
of the coefficients then add up to m times the squared distance. They are
accumulated in sequency order (fewest sign changes first), and an entry whose
sum already exceeds the whole sum of a promising entry is eliminated. A partial
sum never exceeds the whole one, so the result is exact; nothing is rounded.

Spark deals the rows: every round is one pass that assigns rows in their tasks,
adds up each entry's parts per task (at most PARTS * ENTRIES rows a task), merges
the sums by entry, and sends the new codebooks back. A row never leaves its task.

Defined cases: rows whose vector is null, or holds a null or non-finite
component, are dropped. The width of a vector is that of the longest kept one,
rounded up to a multiple of ``PARTS``; shorter vectors count as padded with zeros.
A null vec_id comes last among the rows that start the codebooks, ties are
ordered by the vector. With fewer rows than ``ENTRIES`` the codebooks are as
short. Integers beyond 64 bits are handled exactly; an error beyond a long is
given as the largest long. Repeated rows count one by one; a null label is a
label; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import LAST_ID, checkpoint_ready, table

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Rows whose distances a task works on at a time, and coefficients between eliminations.
BLOCK, STEP = 512, 4
#: Entries are followed one by one when this share of them is left; until then the
#: sums of eliminated ones go on in the matrix, which is faster.
SPARSE = 0.1
#: Labels whose sums are broadcast at most; beyond, rows find them by a shuffle.
FEW_LABELS = 10_000
LARGEST = 2**63 - 1


def transformed(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of the rows, padded with zeros to a power of
    two, with coefficients in sequency order. Integers, or Python integers."""
    n, width = x.shape
    m = 1 << max(0, width - 1).bit_length()
    y = np.zeros((n, m), x.dtype)
    y[:, :width] = x
    size = 1
    while size < m:
        pairs = y.reshape(n, -1, 2, size)
        y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, m)
        size *= 2
    return y[:, sequency(m)]


def sequency(m: int) -> np.ndarray:
    """Places of the transform's coefficients by their number of sign changes:
    the bits of the Gray code of that number, reversed."""
    bits = m.bit_length() - 1
    s = np.arange(m)
    gray, out = s ^ s >> 1, np.zeros(m, np.int64)
    for k in range(bits):
        out |= (gray >> k & 1) << (bits - 1 - k)
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, scaled squared distance) of the nearest of transformed ``entries``
    to each transformed row, ties to the lower index."""
    n, m = x.shape
    best, far = np.zeros(n, np.int64), np.zeros(n, x.dtype)
    for s in range(0, n, BLOCK):
        rows = x[s:s + BLOCK]
        sums, done = np.zeros((len(rows), len(entries)), x.dtype), 0
        while True:
            for c in range(done, min(done + STEP, m)):
                d = rows[:, c, None] - entries[None, :, c]
                d *= d
                sums += d
            done = min(done + STEP, m)
            if done == m:
                break
            # the whole sum of a promising entry bounds the least one
            bound = ((rows - entries[sums.argmin(axis=1)]) ** 2).sum(axis=1)
            live = sums <= bound[:, None]
            if np.count_nonzero(live) <= SPARSE * live.size:
                break
        if done == m:
            best[s:s + BLOCK] = sums.argmin(axis=1)
            far[s:s + BLOCK] = sums[np.arange(len(rows)), best[s:s + BLOCK]]
            continue
        # few entries are left: from here on they are followed one by one
        row, entry = np.nonzero(live)
        sums = sums[row, entry]
        for c in range(done, m, STEP):
            sums = sums + ((rows[row, c:c + STEP] - entries[entry, c:c + STEP]) ** 2).sum(axis=1)
            on = sums <= bound[row]
            row, entry, sums = row[on], entry[on], sums[on]
        # every row still has an entry; its first one of the least sum is the nearest
        least = np.minimum.reduceat(sums, np.searchsorted(row, np.arange(len(rows))))
        at = np.flatnonzero(sums == least[row])
        at = at[np.searchsorted(row[at], np.arange(len(rows)))]
        best[s:s + BLOCK], far[s:s + BLOCK] = entry[at], least
    return best, far


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * value) of finite doubles, as 64-bit integers where all of
    them and their squared distances fit, else as Python integers."""
    largest = np.abs(values).max(initial=0.0)
    width = max(1, values.shape[1])
    # a coefficient is at most width * 2 * largest, and width of their squares are added
    if largest < 2.0**52 and (4 * width * (largest * SCALE + 1)) ** 2 * 2 * width < 2.0**62:
        return np.floor(values * SCALE).astype(np.int64)
    exact = [int(v) * SCALE if abs(v) >= 2.0**52 else int(np.floor(v * SCALE)) for v in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def _matrix(batch, width: int) -> np.ndarray:
    """The vectors of a batch as rows of doubles, padded with zeros."""
    import pyarrow.compute as pc
    column = batch.column("vec")
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Codebooks:
    """``PARTS`` lists of integer entries."""

    def __init__(self, books: list[list[list[int]]]):
        self.books = books
        self.width = sum(len(b[0]) for b in books)

    def sha256(self) -> str:
        values = (str(v) for book in self.books for entry in book for v in entry)
        return hashlib.sha256(",".join(values).encode()).hexdigest()

    def assigned(self, values: np.ndarray):
        """For each part position: its integers, and the index and squared distance of the nearest entries."""
        whole = whole_numbers(values)
        step = self.width // PARTS
        for p, book in enumerate(self.books):
            entries = np.array(book, dtype=object).reshape(len(book), step)
            top = max((abs(v) for entry in book for v in entry), default=0)
            part = whole[:, p * step:(p + 1) * step]
            if part.dtype == object or (4 * max(1, step) * (top + 1)) ** 2 * 2 * max(1, step) >= 2**62:
                part = part.astype(object)
            else:
                entries = entries.astype(np.int64)
            if not step:
                yield part, np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                continue
            x = transformed(part)
            index, far = nearest(x, transformed(entries))
            yield part, index, far // x.shape[1]


def _started(rows: DataFrame, width: int, entries: int) -> Codebooks:
    """Codebooks of the vectors with the smallest ids."""
    first = rows.orderBy(F.coalesce("vec_id", F.lit(LAST_ID)), "vec").limit(entries).select("vec").collect()
    values = np.zeros((len(first), width))
    for i, r in enumerate(first):
        values[i, :len(r["vec"])] = r["vec"]
    whole, step = whole_numbers(values), width // PARTS
    return Codebooks([[[int(v) for v in row[p * step:(p + 1) * step]] for row in whole] for p in range(PARTS)])


def _improved(rows: DataFrame, codebooks: Codebooks) -> Codebooks:
    """One round. Sums travel as text, so they have no largest value."""
    width = codebooks.width
    step = width // PARTS

    def partial(batches):
        import pyarrow as pa
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, (part, index, _) in enumerate(codebooks.assigned(_matrix(batch, width))):
                order = np.argsort(index, kind="stable")
                used, first, count = np.unique(index[order], return_index=True, return_counts=True)
                sums = np.add.reduceat(part[order], first, axis=0)
                for e, n, total in zip(used.tolist(), count.tolist(), sums.tolist(), strict=True):
                    _add(held, (p, e), n, total)
        yield _rows(pa, held)

    def _add(held, key, n, total):
        old = held.get(key)
        held[key] = (n, total) if old is None else (old[0] + n, [a + b for a, b in zip(old[1], total, strict=True)])

    def _rows(pa, held):
        keys = list(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([held[k][0] for k in keys], pa.int64()),
             pa.array([",".join(map(str, held[k][1])) for k in keys], pa.string())], names=["part", "entry", "n", "sums"])

    def merge(batches):
        import pyarrow as pa
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                _add(held, (r["part"], r["entry"]), r["n"], [int(v) for v in r["sums"].split(",")] if r["sums"] else [])
        yield _rows(pa, held)

    schema = "part int, entry int, n long, sums string"
    merged = rows.select("vec").mapInArrow(partial, schema).repartition("part", "entry").mapInArrow(merge, schema)
    books = [[list(entry) for entry in book] for book in codebooks.books]
    for r in merged.collect():  # a row per used entry
        if step:
            books[r["part"]][r["entry"]] = [int(v) // r["n"] for v in r["sums"].split(",")]
    return Codebooks(books)


def vector_codes(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every kept row of
    ``vec_id, embedding, label``."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits, so there are 1 to 256 entries")
    checkpoint_ready(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("vec"), F.col("label").alias("label"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)))
    longest = rows.agg(F.max(F.size("vec"))).first()[0]
    width = -(-(longest or 0) // PARTS) * PARTS
    codebooks = _started(rows, width, entries) if longest is not None else Codebooks([[[]]] * PARTS)
    for _ in range(rounds if longest else 0):
        codebooks = _improved(rows, codebooks)
    coded = _coded(rows, codebooks).checkpoint()
    return _with_label_errors(coded).select("vec_id", "code", "error", "label_error",
                                            F.lit(codebooks.sha256()).alias("codebooks_sha256"))


def _coded(rows: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``vec_id, label, code, error``."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, error = [], 0
            for _, index, far in codebooks.assigned(_matrix(batch, codebooks.width)):
                codes.append(index)
                error = error + far
            names = [f"{e:02x}" for e in range(256)]
            text = ["".join(names[e] for e in row) for row in np.stack(codes, 1).tolist()]
            if error.dtype == object:
                error = [min(e, LARGEST) for e in error]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """With ``label_error``. The sums of few labels are broadcast; those of many
    are found by a shuffle, whose hot labels adaptive execution splits."""
    totals = coded.groupBy(F.col("label").alias("of")).agg(
        F.coalesce(F.try_sum("error"), F.lit(LARGEST)).alias("label_error")).checkpoint()
    if totals.limit(FEW_LABELS + 1).count() <= FEW_LABELS:
        totals = F.broadcast(totals)
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """Every distance of every round, for embeddings of one length."""
    def assign(k):
        return f"""
a{k} AS MATERIALIZED (SELECT i, p, m // 256 AS d, m % 256 AS e FROM (SELECT r.i, r.p, min(256 * list_sum(list_transform(
    range(1, len(r.v) + 1), lambda j: (r.v[j] - c.v[j]) * (r.v[j] - c.v[j]))) + c.e)::BIGINT AS m
  FROM r JOIN c{k} c USING (p) GROUP BY ALL))"""

    def improve(k):
        return f"""
u{k} AS (SELECT p, e, list(x ORDER BY j) AS v FROM (SELECT p, e, j, floor(sum(x) / count(*))::BIGINT AS x FROM (
    SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{k} JOIN r USING (i, p)) GROUP BY ALL) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(u.v, c.v) AS v FROM c{k} c LEFT JOIN u{k} u USING (p, e))"""
    steps = ",".join(assign(k) + "," + improve(k) for k in range(ROUNDS)) + "," + assign(ROUNDS)
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS i, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS MATERIALIZED (SELECT i, p, x[p * (len(x) // 4) + 1:(p + 1) * (len(x) // 4)] AS v FROM kept, (SELECT unnest(range(4)) AS p)),
c0 AS MATERIALIZED (SELECT p, i AS e, v FROM r WHERE i < 256),{steps},
coded AS (SELECT i, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY i),
books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, j)) AS h FROM (
    SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM c{ROUNDS}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (i), books"""


ORACLE_SQL = _sql()
