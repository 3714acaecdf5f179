"""Embedding near-dedup: product quantisation over coarse inverted lists.

1. Equal vectors of a label become one, with a count.
2. Coarse centroids and, on their residuals, one codebook per subspace are
   fitted by k-means on a bounded sample (``FIT_ROWS``); every vector is indexed.
3. A vector lives in the list of its nearest centroid and probes each further
   list whose bisector with its own is within half the link radius. Of two
   vectors closer than the radius one is that near to the other's side, so the
   probes are sufficient: no link is lost, whatever the sample was.
4. In a list, distances come from per-query tables over the residual codes; as
   each resident knows how far its code is off, the bound drops no link either.
   What remains is reranked by exact cosine in double precision.
5. A list is met in tiles of bounded parts of residents and queries. Tiles emit
   link counts per vector and a forest of links, never all pairs. Groups are the
   connected components of the forests.

Defined cases: a vector that is null, empty or zero or holds a null or
non-finite component, or has no label, links with nothing; vectors of different
lengths never link, and lengths other than the sample's commonest share one list
per label without codes; copies of a vector link with each other; repeated rows
are separate vectors; a null id takes part and is never a component's name
unless no member has an id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import checkpoint_ready, table
from cadenza.llm.graph import components
from cadenza.llm.tiles import forest, runs

THRESHOLD, FIT_ROWS, LIST_ROWS, LISTS, SUBSPACES, CODES = 0.98, 20_000, 256, 1024, 8, 64
PART = 1024
#: Slack for rounding where a bound prunes.
SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None, :], 0)


def kmeans(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([squared(x[i:i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
        counts = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, x[:, d], len(centres)) for d in range(x.shape[1])], 1)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return np.unique(centres, axis=0)


class Index:
    """Coarse centroids and residual codebooks for vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int, threshold: float, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
        self.dim = sample.shape[1]
        self.centres = kmeans(sample, lists, 8, rng)
        rest = sample - self.centres[squared(sample, self.centres).argmin(1)]
        self.spans = [s for s in np.array_split(np.arange(self.dim), min(SUBSPACES, self.dim)) if len(s)]
        self.books = [kmeans(rest[:, s], CODES, 8, rng) for s in self.spans]

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's own list, and the boolean matrix of the lists it probes."""
        d = squared(x, self.centres)
        home = d.argmin(1)
        return home, self.margin(d, home) <= self.radius / 2 + SLACK

    def margin(self, d: np.ndarray, home: np.ndarray) -> np.ndarray:
        """How far rows are from the bisector of their list and each other list."""
        apart = np.sqrt(squared(self.centres, self.centres))[home]
        apart[np.arange(len(home)), home] = 1.0
        return (d - d[np.arange(len(home)), home][:, None]) / (2 * np.maximum(apart, SLACK))

    def codes(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Residual codes and how far each code is off its vector."""
        rest = x - self.centres[home]
        codes = np.stack([squared(rest[:, s], b).argmin(1) for s, b in zip(self.spans, self.books, strict=True)], 1)
        off = rest - np.hstack([b[codes[:, m]] for m, b in enumerate(self.books)])
        return codes.astype(np.uint8), np.linalg.norm(off, axis=1)

    def near(self, queries: np.ndarray, at: int, codes: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Matrix of query and resident pairs that may be within the radius."""
        rest = queries - self.centres[at]
        total = np.zeros((len(queries), len(codes)))
        for m, (s, book) in enumerate(zip(self.spans, self.books, strict=True)):
            total += squared(rest[:, s], book)[:, codes[:, m]]
        return np.sqrt(total) <= self.radius + off[None, :] + SLACK


_LISTED = "label long, dim int, list int, query boolean, node long, copies long, home int, vec binary, codes binary, off double"


def _listed(reps: DataFrame, index: Index | None) -> DataFrame:
    """Residents, and queries for every list that a vector probes (its own included)."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for s in range(0, batch.num_rows, 2048):
                part = batch.slice(s, 2048)
                vecs = part.column("vec")
                sizes = np.diff(vecs.offsets.to_numpy())
                flat = vecs.flatten().to_numpy()
                starts = np.cumsum(sizes) - sizes
                raw = [flat[a:a + n].tobytes() for a, n in zip(starts, sizes, strict=True)]
                home = np.zeros(len(sizes), np.int64)
                codes, off = [b""] * len(sizes), np.zeros(len(sizes))
                row, at = np.arange(len(sizes)), np.zeros(len(sizes), np.int64)
                fits = np.nonzero(sizes == index.dim)[0] if index else np.zeros(0, np.int64)
                if len(fits):
                    x = unit(flat[starts[fits][:, None] + np.arange(index.dim)])
                    own, probed = index.probes(x)
                    c, o = index.codes(x, own)
                    home[fits], off[fits] = own, o
                    for k, i in enumerate(fits):
                        codes[i] = c[k].tobytes()
                    q, lists = np.nonzero(probed)
                    others = np.setdiff1d(row, fits)
                    row, at = np.concatenate([fits[q], others]), np.concatenate([lists, np.zeros(len(others), np.int64)])
                rows = np.concatenate([np.arange(len(sizes)), row])
                query = np.arange(len(rows)) >= len(sizes)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("label").take(take), pa.array(sizes[rows].astype(np.int32)),
                     pa.array(np.concatenate([home, at]).astype(np.int32)), pa.array(query),
                     part.column("node").take(take), part.column("copies").take(take),
                     pa.array(home[rows].astype(np.int32)), pa.array([raw[i] for i in rows], pa.binary()),
                     pa.array([b"" if k else codes[i] for i, k in zip(rows, query, strict=True)], pa.binary()),
                     pa.array(np.where(query, 0.0, off[rows]))],
                    names=[c.split()[0] for c in _LISTED.split(", ")])

    return reps.select("label", "node", "copies", "vec").mapInArrow(run, _LISTED)


def _tiled(listed: DataFrame, part: int) -> DataFrame:
    """Rows with the tile they belong to: part i of the residents, part j of the queries."""
    keys = ["label", "dim", "list"]
    counts = listed.groupBy(*keys).agg(F.count_if(~F.col("query")).alias("residents"),
                                       F.count_if(F.col("query")).alias("queries"))
    # a list with residents but one vector in all has nothing to compare
    counts = counts.where("residents > 0 and queries > 1")
    mine = F.when(F.col("query"), F.col("queries")).otherwise(F.col("residents"))
    other = F.when(F.col("query"), F.col("residents")).otherwise(F.col("queries"))
    rows = listed.join(counts, keys).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.ceil(mine / part)).cast("int"))
    rows = rows.withColumn("facing", F.explode(F.sequence(F.lit(0), F.ceil(other / part).cast("int") - 1)))
    return rows.select(*listed.columns, F.when(F.col("query"), F.col("facing")).otherwise(F.col("own")).alias("i"),
                       F.when(F.col("query"), F.col("own")).otherwise(F.col("facing")).alias("j"))


def _compared(tiled: DataFrame, index: Index | None, kind, threshold: float) -> DataFrame:
    """``a, b, n``: with b null, n links of node a; else a link of a tile's forest."""
    keys = ["label", "dim", "list", "i", "j"]

    def tile(t):
        query = t.column("query").to_numpy(zero_copy_only=False)
        if query.all() or not query.any():
            return None
        node, copies, home = (t.column(c).to_numpy() for c in ("node", "copies", "home"))
        x = unit(np.stack([np.frombuffer(v, kind) for v in t.column("vec").to_pylist()]))
        r, q = np.nonzero(~query)[0], np.nonzero(query)[0]
        at = t.column("list")[0].as_py()
        coded = index is not None and t.column("dim")[0].as_py() == index.dim
        if coded:
            column = t.column("codes").take(r_take(r)).to_pylist()
            codes = np.stack([np.frombuffer(c, np.uint8) for c in column])
            a, b = np.nonzero(index.near(x[q], at, codes, t.column("off").to_numpy()[r]))
        else:
            a, b = (v.ravel() for v in np.indices((len(q), len(r))))
        a, b = q[a], r[b]
        on = node[a] != node[b]
        a, b = a[on], b[on]
        close = np.concatenate([(x[a[k:k + 65536]] * x[b[k:k + 65536]]).sum(1) >= threshold
                                for k in range(0, len(a), 65536)] or [np.zeros(0, bool)])
        a, b = a[close], b[close]
        away = home[a] != at  # a link across lists, which the other side may find too
        if coded and away.any():
            _, probed = index.probes(x[b[away]])
            twice = probed[np.arange(away.sum()), home[a[away]]] & (home[a[away]] < at)
            keep = np.ones(len(a), dtype=bool)
            keep[np.nonzero(away)[0][twice]] = False
            a, b, away = a[keep], b[keep], away[keep]
        links = np.bincount(a, copies[b], len(node)) + np.bincount(b[away], copies[a[away]], len(node))
        some = np.nonzero(links)[0]
        root, leaf = forest(node[a], node[b])
        return node[some], links[some].astype(np.int64), root, leaf

    def r_take(r):
        import pyarrow as pa
        return pa.array(r)

    def run(batches):
        import pyarrow as pa
        for batch, starts, ends in runs(batches, keys):
            found = [f for s, e in zip(starts, ends, strict=True) if (f := tile(batch.slice(s, e - s)))]
            if not found:
                continue
            node, links, root, leaf = (np.concatenate(x) for x in zip(*found, strict=True))
            none = np.zeros(len(node), bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([node, root])),
                 pa.array(np.concatenate([node, leaf]), mask=np.concatenate([~none, np.zeros(len(leaf), bool)])),
                 pa.array(np.concatenate([links, np.zeros(len(leaf), np.int64)]))], names=["a", "b", "n"])

    n = int(tiled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tiled.repartition(n, *keys).sortWithinPartitions(*keys, "query", "node").mapInArrow(
        run, "a long, b long, n long")


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS,
                    part: int = PART) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding, label``."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    spark = vectors.sparkSession
    checkpoint_ready(spark)
    kind = np.float32 if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else np.float64
    e = F.col("embedding")
    if kind is np.float64:
        e = e.cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          e.alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = (F.col("label").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda v: v != 0))
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False)))
    reps = (rows.where("valid").groupBy("label", "vec")
            .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
            .withColumn("node", F.monotonically_increasing_id()).checkpoint())

    sample = [np.array(r["vec"], np.float64) for r in
              reps.orderBy(F.xxhash64("vec", "label"), "node").limit(fit_rows).select("vec").collect()]
    index = None
    if sample:
        sizes = np.array([len(x) for x in sample])
        dim = int(np.bincount(sizes).argmax())
        lists = int(np.clip(reps.count() // LIST_ROWS, 1, LISTS))
        index = Index(unit(np.stack([x for x in sample if len(x) == dim])), lists, threshold)

    listed = _listed(reps, index)
    found = _compared(_tiled(listed, part), index, kind, threshold).checkpoint()
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    groups = components(found.where("b is not null").select("a", "b"))
    named = (reps.join(counts, reps["node"] == counts["a"], "left").drop("a")
             .join(groups.withColumnRenamed("node", "g"), F.col("node") == F.col("g"), "left")
             .select("label", "vec", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("root")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("label", "vec", "n_links", "component_id")
    linked = rows.where("valid").join(named, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))
