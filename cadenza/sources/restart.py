"""Restart points inside gzip archives, so one archive is read by many tasks.

A gzip stream can be entered where a deflate block begins, given the 32 KB before
it. Blocks begin at any bit and nothing marks them, so they are searched for: a
block's header has fields that few random bits satisfy (its code lengths must form
a complete code), and a place that satisfies them counts only if decompression from
there, with the bytes before it as dictionary, gives the same bytes as the stream
itself. The start of a further gzip member is a restart point as well.

:func:`index_archives` reads each archive once, front to back, and lists its restart
points with the first tar member after each; the index is a small table that can be
kept. :func:`read_indexed` then reads every segment in a task of its own, and checks
the bytes between two restart points against the checksum of the index.
"""

from __future__ import annotations

import io
import tarfile
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .archive import _batched, _fs_and_path, _members, _schema

#: Decompressed bytes between restart points, about.
SPACING = 8 << 20
#: Compressed bytes that are searched for a block at a time, and verified from it.
SEARCH, VERIFY = 1 << 17, 1 << 16
WINDOW = 1 << 15

INDEX_SCHEMA = ("path string, segment int, byte long, bit int, member boolean, window binary, begins long, "
                "first long, until long, size long, crc long")


def block_starts(data: bytes) -> np.ndarray:
    """The bits of ``data`` where the header of a (not last) dynamic deflate block could
    begin: its type, its counts, and code lengths that make a complete code."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    n = len(bits) - 17 - 57
    if n <= 0:
        return np.zeros(0, np.int64)

    def number(at, size):
        return sum(bits[at + k].astype(np.int32) << k for k in range(size))
    at = np.flatnonzero((bits[:n] == 0) & (bits[1:n + 1] == 0) & (bits[2:n + 2] == 1))
    at = at[(number(at + 3, 5) <= 29) & (number(at + 8, 5) <= 29)]
    lengths = number(at + 13, 4) + 4
    kraft = np.zeros(len(at), np.int32)
    for k in range(19):
        size = number(at + 17 + 3 * k, 3)
        kraft += np.where((k < lengths) & (size > 0), 128 >> np.minimum(size, 7), 0)
    return at[kraft == 128]


def shifted(data: bytes, bit: int) -> bytes:
    """The bits of ``data`` from ``bit`` on, aligned to bytes."""
    a = np.frombuffer(data, np.uint8)[bit // 8:].astype(np.uint16)
    bit %= 8
    if not bit:
        return a.astype(np.uint8).tobytes()
    high = np.append(a[1:], 0)
    return ((a >> bit | high << (8 - bit)) & 255).astype(np.uint8).tobytes()


class Inflater:
    """Decompressed bytes of a seekable gzip file from a restart point, as a stream."""

    MAGIC = b"\x1f\x8b"

    def __init__(self, file, byte: int = 0, bit: int = 0, window: bytes | None = None, member: bool = True):
        self.file, self.byte, self.bit, self.raw = file, byte, bit, not member
        file.seek(byte)
        self.engine = zlib.decompressobj(31) if member else zlib.decompressobj(-15, zdict=window)
        self.carry, self.fed, self.held = b"", 0, b""

    def _compressed(self, size: int = 1 << 18) -> bytes:
        """The next bytes of the stream, shifted to start where it was entered."""
        data = self.file.read(size)
        if not self.raw or not self.bit:
            return data
        if not data:
            last, self.carry = self.carry, b""
            return shifted(last, self.bit) if last else b""
        joined = self.carry + data
        self.carry = joined[-1:]
        return shifted(joined, self.bit)[:-1] or self._compressed(size)

    def read(self, size: int) -> bytes:
        """The next bytes, at most ``size``; none at the end."""
        if not self.held:
            self.held = self._more()
        out, self.held = self.held[:size], self.held[size:]
        return out

    def _more(self) -> bytes:
        while True:
            if self.engine.eof:
                rest = self._next_member()
                if not rest:
                    return b""
                self.engine = zlib.decompressobj(31)
            else:
                rest = self._compressed()
                if not rest:
                    raise EOFError("the gzip stream ends early")
                self.fed += len(rest)
            if out := self.engine.decompress(rest):
                return out

    def _next_member(self) -> bytes:
        """Bytes of the file from the next gzip member on; none where there is none."""
        rest = self.engine.unused_data
        if self.raw:
            # the last block ended in the byte before this place or, entered inside a
            # byte, in this one; a checksum of 8 bytes follows from the next whole byte
            self.file.seek(self.byte + self.fed - len(rest))
            rest, self.raw = self.file.read(1 << 18), False
            if len(rest) < 8:
                raise EOFError("the gzip stream ends early")
            rest = rest[9:] if self.bit and rest[8:10] != self.MAGIC else rest[8:]
        while len(rest) < 2 and (more := self.file.read(1 << 18)):
            rest += more
        if rest[:2] == self.MAGIC:
            return rest
        while not rest.strip(b"\0"):
            rest = self.file.read(1 << 18)
            if not rest:
                return b""
        raise EOFError("bytes after the gzip stream")


class _Recorder(io.RawIOBase):
    """Decompresses a gzip file front to back and notes restart points on the way."""

    def __init__(self, stream, spacing: int):
        self.stream, self.spacing = stream, spacing
        self.engine, self.data, self.at = zlib.decompressobj(31), b"", 0  # ``data`` starts at file byte ``at``
        self.out, self.total, self.window = b"", 0, b""
        self.last_byte = b""
        self.points = [(0, 0, True, b"", 0)]
        self.sums = [0]
        self.ended = False

    def readable(self):
        return True

    def readinto(self, buffer):
        while not self.out and not self.ended:
            self._step()
        n = min(len(buffer), len(self.out))
        buffer[:n] = self.out[:n]
        self.out = self.out[n:]
        return n

    def _took(self, made: bytes) -> None:
        self.sums[-1] = zlib.crc32(made, self.sums[-1])
        self.out += made
        self.total += len(made)
        self.window = (self.window + made)[-WINDOW:] if len(made) < WINDOW else made[-WINDOW:]

    def _feed(self, size: int) -> None:
        """Decompress the next ``size`` bytes held, across the ends of gzip members."""
        part, self.data, self.at = self.data[:size], self.data[size:], self.at + size
        self.last_byte = part[-1:] or self.last_byte
        while part:
            made = self.engine.decompress(part)
            self._took(made)
            part = self.engine.unused_data if self.engine.eof else b""
            if self.engine.eof:
                if not part:
                    if not self.data:
                        self.data = self.stream.read(SEARCH)
                    if not self.data:
                        self.ended = True
                        return
                elif not part.strip(b"\0") and not self.data.strip(b"\0"):
                    rest = self.stream.read(SEARCH)
                    if not rest.strip(b"\0"):
                        self.ended = True
                        return
                    self.data += rest
                self.engine = zlib.decompressobj(31)
                if self.total - self.points[-1][4] >= self.spacing:
                    self._note(self.at - len(part), 0, True, b"")

    def _note(self, byte: int, bit: int, member: bool, window: bytes) -> None:
        self.points.append((byte, bit, member, window, self.total))
        self.sums.append(0)

    def _step(self) -> None:
        if len(self.data) < SEARCH + VERIFY:
            self.data += self.stream.read(SEARCH + VERIFY)
        if not self.data:
            if not self.engine.eof:
                raise EOFError("the gzip stream ends early")
            self.ended = True
            return
        if self.total - self.points[-1][4] < self.spacing:
            self._feed(min(len(self.data), SEARCH))
            return
        held, fed = self.data[:SEARCH + 400], 0
        for q in block_starts(held[:SEARCH]).tolist():
            need = -(-q // 8)
            if need < fed or not q:
                continue
            trial = shifted(held[q // 8:q // 8 + 400], q % 8)
            try:  # most places fail at once, in the header or the first codes
                zlib.decompressobj(-15, zdict=b"\0" * WINDOW).decompress(trial)
            except zlib.error:
                continue
            self._feed(need - fed)
            fed = need
            if self.ended or self.engine.eof:
                return
            if self._verified(q):
                self._note(self.at - need + q // 8, q % 8, False, self.window)
                return
        self._feed(min(len(self.data), SEARCH - fed))

    def _verified(self, q: int) -> bool:
        """Does the stream entered at bit ``q``, in the last byte fed or just after it, go on as this one does?"""
        part = self.data[:VERIFY]
        ahead = self.engine.copy().decompress(part)
        first = self.last_byte if q % 8 else b""
        try:
            made = zlib.decompressobj(-15, zdict=self.window).decompress(shifted(first + part, q % 8))
        except zlib.error:
            return False
        size = min(len(made), len(ahead))
        return size > 0 and made[:size] == ahead[:size] and abs(len(made) - len(ahead)) < 1024


def index_archives(spark: SparkSession, paths: list[str], spacing: int = SPACING) -> DataFrame:
    """A row per segment of each gzip archive: where it can be entered, the 32 KB before,
    the place of its first tar member and of the next segment's, and its checksum.
    One task per archive; keep the table and read the archive from it many times."""
    from .storage import qualify
    plist = list(dict.fromkeys(qualify(spark, p) for p in paths))
    named = spark.createDataFrame([(p,) for p in plist], "path string").repartitionByRange(max(1, len(plist)), "path")

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fsys, inner = _fs_and_path(path)
                with fsys.open_input_stream(inner, compression=None) as stream:
                    recorder = _Recorder(io.BufferedReader(stream, 1 << 20), spacing)
                    with tarfile.open(fileobj=io.BufferedReader(recorder, 1 << 16), mode="r|") as tar:
                        starts = [info.offset for info in tar]
                    while recorder.readinto(bytearray(1 << 20)):  # the padding at the end
                        pass
                starts = np.array(starts + [np.iinfo(np.int64).max], np.int64)
                begins = np.array([p[4] for p in recorder.points])
                first = starts[np.searchsorted(starts, begins)]
                until, sizes = np.append(first[1:], starts[-1]), np.diff(np.append(begins, recorder.total))
                for i, (p, a, u, n, crc) in enumerate(zip(recorder.points, first, until, sizes, recorder.sums, strict=True)):
                    if a < u:
                        yield pa.RecordBatch.from_pydict({
                            "path": [path], "segment": pa.array([i], pa.int32()), "byte": [p[0]], "bit": pa.array([p[1]], pa.int32()),
                            "member": [p[2]], "window": [p[3]], "begins": [p[4]], "first": [int(a)], "until": [int(u)],
                            "size": [int(n)], "crc": [crc]})
    return named.mapInArrow(run, INDEX_SCHEMA)


class _Checked(io.RawIOBase):
    """The bytes of a segment and beyond; those of the segment are summed."""

    def __init__(self, inflater: Inflater, size: int, crc: int, what: str):
        self.inflater, self.left, self.crc, self.sum, self.what = inflater, size, crc, 0, what

    def readable(self):
        return True

    def readinto(self, buffer):
        data = self.inflater.read(len(buffer))
        buffer[:len(data)] = data
        if self.left:
            own = data[:self.left]
            self.left -= len(own)
            self.sum = zlib.crc32(own, self.sum)
            if not self.left and self.sum != self.crc:
                raise IOError(f"checksum of {self.what} differs from its index")
        return len(data)


def read_indexed(index: DataFrame, suffix: str | None = ".h5", content: bool = True) -> DataFrame:
    """The members of indexed archives, as :func:`.archive.read_archives` gives them:
    a segment's task reads the members that begin in it, over its end if need be."""
    n = index.count()

    def run(batches):
        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    fsys, inner = _fs_and_path(r["path"])
                    with fsys.open_input_file(inner) as f:
                        inflater = Inflater(f, r["byte"], r["bit"], r["window"], r["member"])
                        source = io.BufferedReader(_Checked(inflater, r["size"], r["crc"], f"{r['path']}, segment {r['segment']}"), 1 << 16)
                        skip = r["first"] - r["begins"]
                        while skip:
                            skip -= len(source.read(min(skip, 1 << 20)))
                        with tarfile.open(fileobj=source, mode="r|") as tar:
                            own = (info for info in _until(tar, r["until"] - r["first"]))
                            yield from _members(_Walk(tar, own), r["path"], suffix, None, content)
                        while source.raw.left and source.read(1 << 20):
                            pass
        yield from _batched(rows())

    # a segment is a task's work, whatever its archive
    return index.repartition(max(1, n), "path", "segment").mapInArrow(run, _schema(content))


def _until(tar: tarfile.TarFile, end: int):
    for info in tar:
        if info.offset >= end:
            return
        yield info


class _Walk:
    """The chosen members of an archive, for :func:`.archive._members`."""

    def __init__(self, tar: tarfile.TarFile, members):
        self.tar, self.members = tar, members

    def __iter__(self):
        return iter(self.members)

    def extractfile(self, info):
        return self.tar.extractfile(info)
