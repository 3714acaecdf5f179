import io
import math
import tarfile

import pytest
from pyspark.sql import functions as F

from cadenza.plans import fixtures as fx
from cadenza.sources import archive, records


def _make_archive(path, members, with_dir=True, extra=()):
    with tarfile.open(path, "w:gz") as tar:
        if with_dir:
            d = tarfile.TarInfo("songs/")
            d.type = tarfile.DIRTYPE
            tar.addfile(d)
        for name, data in list(members) + list(extra):
            ti = tarfile.TarInfo(name)
            ti.size = len(data)
            tar.addfile(ti, io.BytesIO(data))


@pytest.fixture()
def archives(tmp_path):
    a = tmp_path / "A.tar.gz"
    b = tmp_path / "B.tar.gz"
    _make_archive(a, [("songs/s1.h5", b"x" * 10), ("songs/s2.h5", b""),
                      ("songs/big.h5", bytes(range(256)) * 400)],
                  extra=[("songs/notes.txt", b"skip me")])
    _make_archive(b, [("songs/t1.h5", b"abc")], with_dir=False)
    return str(a), str(b)


def test_archive_members_filters_and_dedupes(spark, archives):
    a, b = archives
    m = archive.read_archives(spark, [a, b, a], suffix=".h5")  # A listed twice
    rows = {(r["path"].rsplit("/", 1)[-1], r["member"]): (r["size"], len(r["content"]))
            for r in m.collect()}
    assert m.count() == 4
    assert rows[("A.tar.gz", "songs/s1.h5")] == (10, 10)
    assert rows[("A.tar.gz", "songs/s2.h5")] == (0, 0)
    assert rows[("A.tar.gz", "songs/big.h5")] == (102400, 102400)
    assert rows[("B.tar.gz", "songs/t1.h5")] == (3, 3)


def test_archive_all_members_and_cap(spark, archives):
    a, _ = archives
    assert archive.read_archives(spark, a, suffix=None).count() == 4
    assert archive.read_archives(spark, a, suffix=None, max_members=2).count() == 2


def test_archive_streaming_reader_agrees(spark, archives):
    a, b = archives
    s = archive.read_archives_streaming(spark, [a, b, b], suffix=".h5")
    m = archive.read_archives(spark, [a, b], suffix=".h5")
    key = lambda r: (r["path"].rsplit("/", 1)[-1], r["member"], r["size"], bytes(r["content"]))
    assert sorted(map(key, s.collect())) == sorted(map(key, m.collect()))


def test_pack_write_read_round_trip(spark, sf, tmp_path):
    pages = fx.table(spark, sf, "pages")
    packed = archive.pack_archives(pages.withColumn("g", F.floor(F.col("page_id") / 40)),
                                   "g", F.concat(F.col("page_id").cast("string"), F.lit(".html")),
                                   "html", prefix="p")
    n_files = archive.write_files(packed, str(tmp_path / "out"))
    assert n_files == pages.select(F.floor(F.col("page_id") / 40)).distinct().count()
    m = archive.read_archives(spark, str(tmp_path / "out") + "/*.tar.gz", suffix=".html")
    got = m.select(F.regexp_extract("member", r"(\d+)\.html$", 1).cast("bigint").alias("page_id"),
                   "content")
    joined = got.join(pages, "page_id").filter(F.col("content").cast("string") != F.col("html"))
    assert got.count() == pages.count() and joined.count() == 0


def test_flatten_records(spark, sf):
    rec = fx.song_record(spark, sf)
    flat = records.flatten_records(rec, keep=["song_id"])
    assert flat.columns == ["song_id"] + [records.flat_name(p) for p in records.RECORD_FIELDS]
    assert dict(flat.dtypes)["year"] == "double"
    nan_rows = flat.filter(F.isnan("danceability")).count()
    assert nan_rows == 0
    raw = records.flatten_records(rec, nan_zero=False)
    assert raw.filter(F.isnan("danceability")).count() > 0
    known = records.known_year(flat)
    assert known.filter(F.col("year") == 0).count() == 0 and known.count() < flat.count()
    vec = records.as_vector(known).first()["value"]
    assert len(vec) == 16 and not any(math.isnan(v) for v in vec)


def test_fs_uri_forms(tmp_path):
    fsys, p = archive._fs_and_path("file:" + str(tmp_path))
    assert p == str(tmp_path) and fsys.get_file_info(p).type.name == "Directory"
    fsys, p = archive._fs_and_path("file:///" + str(tmp_path).lstrip("/"))
    assert p == str(tmp_path)
    fsys, p = archive._fs_and_path(str(tmp_path))
    assert p == str(tmp_path)


def test_qualify_paths(spark, tmp_path):
    from cadenza.sources import storage
    q = storage.qualify(spark, str(tmp_path))
    assert q.startswith("file:") and q.endswith(str(tmp_path))
    fsys, p = archive._fs_and_path(q)
    assert p == str(tmp_path)


def test_pack_splits_a_hot_group_of_copies(spark, tmp_path):
    # 1200 identical copies in one group: split into several archives, none lost
    rows = [(0, "same.h5", "x" * 10)] * 1200 + [(1, f"m{i}.h5", "y") for i in range(5)]
    df = spark.createDataFrame(rows, "g int, name string, body string")
    packed = archive.pack_archives(df, "g", "name", "body", prefix="p", max_members=100)
    names = sorted(r["path"] for r in packed.select("path").collect())
    assert "p-1.tar.gz" in names and len([n for n in names if n.startswith("p-0-")]) >= 8
    out = str(tmp_path / "hot")
    archive.write_files(packed, out)
    m = archive.read_archives(spark, out + "/*.tar.gz", suffix=".h5")
    per = {r["path"].rsplit("/", 1)[-1]: r["count"] for r in m.groupBy("path").count().collect()}
    assert sum(per.values()) == 1205 and max(per.values()) < 300
