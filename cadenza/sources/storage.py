"""Small file-system helpers through the session's Hadoop configuration, so
they work for whatever shared storage the cluster uses."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

# One-time materialisations in this process run one at a time.
MATERIALIZE_LOCK = threading.RLock()


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A file with these bytes: written under a name of its own, then renamed."""
    fs, p = _fs(spark, path)
    own = _fs(spark, f"{path}.{uuid.uuid4().hex}")[1]
    out = fs.create(own, True)
    for i in range(0, len(data), 1 << 20):
        out.write(bytearray(data[i:i + (1 << 20)]))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    fs.rename(own, p)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """The bytes of a file of moderate size."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified URI of ``path`` under the session's default file system
    (``/x`` becomes ``hdfs://nn:8020/x`` on HDFS, ``file:/x`` locally), so
    code outside the JVM (pyarrow in tasks) resolves it to the same place."""
    fs, p = _fs(spark, path)
    return str(fs.makeQualified(p).toString())


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of every file at or below ``path``."""
    fs, p = _fs(spark, path)
    found, out = fs.listFiles(p, True), []
    while found.hasNext():
        f = found.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def glob(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, length) of the files that a path or glob names."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p) or []
    return sorted((f.getPath().toString(), f.getLen()) for f in found if f.isFile())


def publish(spark: SparkSession, path: str, write: Callable[[str], object]) -> str:
    """``path``, written once: ``write`` fills a hidden folder of its own name,
    which is renamed when complete. A reader never sees a part of it, and of
    two drivers that write the same path one wins and the other's is dropped."""
    with MATERIALIZE_LOCK:
        if exists(spark, path):
            return path
        parent, name = path.rsplit("/", 1)
        own = f"{parent}/_writing-{uuid.uuid4().hex}-{name}"
        write(own)
        fs, final = _fs(spark, path)
        temporary = _fs(spark, own)[1]
        if fs.exists(final) or not fs.rename(temporary, final):
            fs.delete(temporary, True)
            if not fs.exists(final):
                raise OSError(f"could not publish {path}")
        return path
