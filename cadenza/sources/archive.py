"""tar.gz archives -> one row per member: ``path, member, size, content``.

gzip is not splittable, so one archive is one unit of work. Archives are
spread over tasks by Spark's file scan (``binaryFile``) and unpacked in
``mapInArrow`` with the standard ``tarfile`` module; members are read in
full (no short reads) and emitted in bounded Arrow batches. Unpacking one
archive is inherently one task; pass ``repartition=n`` to spread the member
rows afterwards, so per-member work downstream is not held in the task of
an archive that holds a large share of all members.

:func:`read_archives` takes archives of any size: those that fit a cell come
through ``binaryFile``, larger ones are opened inside their task through
``pyarrow.fs`` and streamed (:func:`read_archives_streaming`), or taken apart at
restart points (``split_over``). With
``content=False`` only names and sizes leave the task.
"""

from __future__ import annotations

import gzip
import io
import posixpath
import tarfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEMBER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("member", T.StringType(), False),
    T.StructField("size", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])
_BATCH_ROWS = 256
_BATCH_BYTES = 64 << 20


#: ``binaryFile`` holds a file in one cell, of 2 GB at most.
CELL_BYTES = 1 << 30


def _schema(content: bool) -> T.StructType:
    return MEMBER_SCHEMA if content else T.StructType(MEMBER_SCHEMA.fields[:3])


def _members(tar: tarfile.TarFile, path: str, suffix: str | None, max_members: int | None,
             content: bool = True):
    taken = 0
    for info in tar:
        if max_members is not None and taken >= max_members:
            break
        if not info.isfile():
            continue
        if suffix is not None and not info.name.endswith(suffix):
            continue
        if not content:
            # the size of the header; the reader skips that many bytes and
            # fails on an archive that ends before
            taken += 1
            yield path, info.name, info.size
            continue
        f = tar.extractfile(info)
        data = f.read() if f is not None else b""
        if len(data) != info.size:
            raise IOError(f"short read of {info.name} in {path}")
        taken += 1
        yield path, info.name, info.size, data


def _arrow_batch(buf):
    import pyarrow as pa
    types = [pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["path", "member", "size", "content"]
    cols = [pa.array(c, t) for c, t in zip(zip(*buf), types)]
    return pa.RecordBatch.from_arrays(cols, names=names[:len(cols)])


def _batched(rows):
    """Member rows as Arrow record batches of bounded rows and bytes."""
    buf, nbytes = [], 0
    for r in rows:
        buf.append(r)
        nbytes += r[2] if len(r) > 3 else 0
        if len(buf) >= _BATCH_ROWS or nbytes >= _BATCH_BYTES:
            yield _arrow_batch(buf)
            buf, nbytes = [], 0
    if buf:
        yield _arrow_batch(buf)


def extract_members(archives: DataFrame, suffix: str | None = ".h5",
                    max_members: int | None = None, path_col: str = "path",
                    content_col: str = "content", repartition: int | None = None,
                    content: bool = True) -> DataFrame:
    """Unpack a ``(path, content)`` frame of tar.gz bytes. Keeps regular
    files whose name ends with ``suffix`` (all when ``None``), at most
    ``max_members`` per archive; with ``content=False`` without their bytes."""
    src = archives.select(F.col(path_col).alias("path"), F.col(content_col).alias("content"))

    def unpack(batches):
        def rows():
            for batch in batches:
                paths = batch.column("path").to_pylist()
                packed = batch.column("content")
                for k, path in enumerate(paths):
                    with tarfile.open(fileobj=io.BytesIO(packed[k].as_py()), mode="r:*") as tar:
                        yield from _members(tar, path, suffix, max_members, content)
        yield from _batched(rows())

    out = src.mapInArrow(unpack, _schema(content))
    return out.repartition(repartition) if repartition else out


def read_archives(spark: SparkSession, paths: str | list[str], suffix: str | None = ".h5",
                  max_members: int | None = None, repartition: int | None = None,
                  content: bool = True, split_over: int | None = None) -> DataFrame:
    """Archive files (paths or globs; duplicates removed) of any size -> member rows.
    Gzip archives of more than ``split_over`` bytes are indexed in one pass and then
    read by many tasks each, from restart points (:mod:`.restart`); to read one
    again, keep the index."""
    from .storage import glob
    if split_over is not None and max_members is not None:
        raise ValueError("max_members counts the members of a whole archive, which split_over takes apart")
    plist = [paths] if isinstance(paths, str) else list(dict.fromkeys(paths))
    files = dict(f for p in plist for f in glob(spark, p))
    if not files:
        raise FileNotFoundError(f"no archive at {plist}")
    split = [f for f, size in files.items() if split_over is not None and size > split_over]
    small = [f for f, size in files.items() if size <= CELL_BYTES and f not in split]
    large = [f for f, size in files.items() if size > CELL_BYTES and f not in split]
    out = None
    if split:
        from ..session import checkpoint_root
        from .restart import index_archives, read_indexed
        checkpoint_root(spark)
        out = read_indexed(index_archives(spark, split).checkpoint(), suffix, content)
    if small:
        cells = spark.read.format("binaryFile").load(small).select("path", "content")
        whole = extract_members(cells, suffix, max_members, content=content)
        out = whole if out is None else out.unionByName(whole)
    if large:
        streamed = read_archives_streaming(spark, large, suffix, max_members, content=content)
        out = streamed if out is None else out.unionByName(streamed)
    return out.repartition(repartition) if repartition else out


def read_archives_streaming(spark: SparkSession, paths: list[str], suffix: str | None = ".h5",
                            max_members: int | None = None,
                            repartition: int | None = None, content: bool = True) -> DataFrame:
    """Like :func:`read_archives` with each path opened inside its task through
    ``pyarrow.fs`` (local, HDFS, S3, ...) and streamed. Paths are qualified
    against the session's default file system first."""
    from .storage import qualify
    plist = list(dict.fromkeys(qualify(spark, p) for p in paths))
    pdf = spark.createDataFrame([(p,) for p in plist], "path string")
    # range partitioning over distinct paths: about one archive per task
    # (hash partitioning could put two large archives into one task)
    pdf = pdf.repartitionByRange(max(1, len(plist)), "path")

    def unpack(batches):
        def rows():
            for b in batches:
                for path in b.column("path").to_pylist():
                    fsys, inner = _fs_and_path(path)
                    with fsys.open_input_stream(inner, compression=None) as stream:
                        yield from _streamed(stream, path, suffix, max_members, content)
        yield from _batched(rows())

    out = pdf.mapInArrow(unpack, _schema(content))
    return out.repartition(repartition) if repartition else out


def _streamed(stream, path: str, suffix: str | None, max_members: int | None, content: bool):
    """Members of an archive read front to back. A gzip archive that ends early
    raises, which ``tarfile``'s own stream mode would pass over."""
    raw = io.BufferedReader(stream, 1 << 20)
    if raw.peek(2)[:2] == b"\x1f\x8b":
        with gzip.GzipFile(fileobj=raw) as unzipped, tarfile.open(fileobj=unzipped, mode="r|") as tar:
            yield from _members(tar, path, suffix, max_members, content)
            if max_members is None:
                while unzipped.read(1 << 20):  # up to the checksum
                    pass
    else:
        with tarfile.open(fileobj=raw, mode="r|*") as tar:
            yield from _members(tar, path, suffix, max_members, content)


def _fs_and_path(uri: str):
    """A ``pyarrow.fs`` file system and the path inside it, for plain local
    paths, ``file:`` URIs and scheme URIs (``hdfs://``, ``s3://``, ...)."""
    from pyarrow import fs as pafs
    if uri.startswith("file:"):
        rest = uri[len("file:"):]
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


# --- building archives (fixtures and tests) ------------------------------------

ARCHIVE_SCHEMA = "path string, content binary"
BROADCAST_MAX_GROUPS = 200_000  # size bound for broadcasting the group counts


def pack_archives(df: DataFrame, group_col, name_col, content_col,
                  prefix: str = "archive", extra_members: bool = True,
                  max_members: int = 1000) -> DataFrame:
    """Pack rows into tar.gz archives per ``group_col`` value -> ``(path, content)``.

    A group with more than ``max_members`` rows (for example many copies of
    one item) is split into ``ceil(n / max_members)`` archives by a salt from
    a per-row id taken at the scan, so identical copies spread too and no
    group is held by one task; the group counts are a pre-aggregated job.
    Archives of groups within the cap are named ``{prefix}-{group}.tar.gz``,
    split ones ``{prefix}-{group}-{part}.tar.gz``. With ``extra_members``
    each archive also holds a directory entry and a ``README`` member, which
    readers must skip.
    """
    def col(c):
        return F.col(c) if isinstance(c, str) else c

    src = df.select(col(group_col).alias("g"), col(name_col).cast("string").alias("name"),
                    col(content_col).alias("data"),
                    F.monotonically_increasing_id().alias("_rid"))
    counts = src.groupBy("g").agg(F.count(F.lit(1)).alias("_n"))
    # the counts have one row per group: broadcast them when that is checked
    # to be small (no shuffle of the content for the join), else a shuffle
    # join whose hot partition adaptive skew handling splits
    n_groups = counts.count()
    if n_groups <= BROADCAST_MAX_GROUPS:
        counts = F.broadcast(counts)
    parts = F.ceil(F.col("_n") / F.lit(max_members))
    src = (src.join(counts, "g")
              .withColumn("s", F.when(parts <= 1, F.lit(0))
                          .otherwise(F.pmod(F.xxhash64("_rid"), parts).cast("int")))
              .select("g", "s", "name", "data"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        g, part = pdf["g"].iloc[0], int(pdf["s"].iloc[0])
        buf = io.BytesIO()
        with tarfile.open(fileobj=buf, mode="w:gz") as tar:
            if extra_members:
                d = tarfile.TarInfo("members/")
                d.type = tarfile.DIRTYPE
                tar.addfile(d)
                note = b"member listing\n"
                ti = tarfile.TarInfo("README")
                ti.size = len(note)
                tar.addfile(ti, io.BytesIO(note))
            for name, data in zip(pdf["name"], pdf["data"]):
                b = data.encode("utf-8") if isinstance(data, str) else bytes(data)
                ti = tarfile.TarInfo(posixpath.join("members", name))
                ti.size = len(b)
                tar.addfile(ti, io.BytesIO(b))
        name = f"{prefix}-{g}.tar.gz" if part == 0 else f"{prefix}-{g}-{part}.tar.gz"
        return pd.DataFrame({"path": [name], "content": [buf.getvalue()]})

    return src.groupBy("g", "s").applyInPandas(build, ARCHIVE_SCHEMA)


def _is_there(fsys, path: str) -> bool:
    from pyarrow import fs as pafs
    return fsys.get_file_info(path).type == pafs.FileType.File


def write_files(files: DataFrame, out_dir: str) -> int:
    """Write each ``(path, content)`` row as a file named ``basename(path)``
    under ``out_dir`` (any ``pyarrow.fs`` URI; pass a qualified one, see
    :func:`cadenza.sources.storage.qualify`). Every attempt writes under a
    name of its own and moves the finished file; of two attempts at one file
    the first to finish stays. Returns the number of files."""
    out_dir = out_dir.rstrip("/")

    def write(batches):
        fsys, root = _fs_and_path(out_dir)
        fsys.create_dir(root, recursive=True)
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                name = posixpath.basename(path)
                final, tmp = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}.tmp"
                with fsys.open_output_stream(tmp, compression=None) as f:
                    f.write(content)
                try:
                    if not _is_there(fsys, final):
                        fsys.move(tmp, final)
                        continue
                except OSError:  # another attempt finished in between
                    if not _is_there(fsys, final):
                        raise
                fsys.delete_file(tmp)
            yield pd.DataFrame({"n": [len(pdf)]})

    return int(files.mapInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0)
