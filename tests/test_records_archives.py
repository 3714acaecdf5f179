"""One-to-many stages, rejected lines, nested records of any shape, restart points in archives."""

import gzip
import hashlib
import io
import random
import sys
import tarfile
import zlib

import pytest
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cadenza.operators import features as fe
from cadenza.operators import songs
from cadenza.sources import records, restart

cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --- one to many ---------------------------------------------------------------------

def words(text):
    return text.split() if text else None


ROWS = [(1, "a b c", "x"), (2, "", "y"), (3, None, "z"), (4, "d", None), (4, "d", None)]


def test_one_to_many_carries_columns(spark):
    df = spark.createDataFrame(ROWS, "id int, text string, `value` string")
    out = fe.FlatMapFn(words, "text", "word", "string", positionCol="nth").transform(df)
    assert out.columns == ["id", "text", "value", "nth", "word"]
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, [
        (1, "a b c", "x", 0, "a"), (1, "a b c", "x", 1, "b"), (1, "a b c", "x", 2, "c"), (4, "d", None, 0, "d"), (4, "d", None, 0, "d")]))
    outer = fe.FlatMapFn(words, "text", "word", "string", outer=True).transform(df)
    assert sorted((r.id, r.word or "-") for r in outer.collect()) == [
        (1, "a"), (1, "b"), (1, "c"), (2, "-"), (3, "-"), (4, "d"), (4, "d")]


def test_one_to_many_replaces_columns_and_nests_in_a_pipeline(spark):
    df = spark.createDataFrame(ROWS, "place int, text string, input string")
    stages = [fe.FlatMapFn(words, "text", "TEXT", "string", positionCol="input"),
              fe.ColumnFn(F.upper, "TEXT", "upper")]
    out = PipelineModel(stages=stages).transform(df)
    assert out.columns == ["place", "input", "TEXT", "upper"]
    assert sorted((r.place, r.input, r.upper) for r in out.collect()) == [(1, 0, "A"), (1, 1, "B"), (1, 2, "C"), (4, 0, "D"), (4, 0, "D")]
    assert fe.FlatMapFn(words, "text", "w", "string").transform(df.where("false")).collect() == []


def test_one_to_many_is_handed_on_in_bounded_batches(spark):
    def many(n):
        return ({"k": i, "sq": float(i * i)} for i in range(n))
    df = spark.range(3).select((F.col("id") * 5000).alias("n"))
    stage = fe.FlatMapFn(many, "n", "out", "struct<k: int, sq: double>", batchRows=100)
    got = stage.transform(df).mapInArrow(lambda bs: (b.slice(0, 1) if b.num_rows <= 10_000 else b for b in bs), "n long, out struct<k: int, sq: double>")
    assert got.count() > 0
    assert stage.transform(df).agg(F.sum("out.k")).first()[0] == sum(range(5000)) + sum(range(10_000))


# --- rejected lines ------------------------------------------------------------------

def test_songs_and_rejects_land_from_one_scan(spark, tmp_path):
    lines = [("a", "2001.0,1,2,3,9"), ("b", "x,1,2,3,9"), ("c", "2001,,y,3"), ("d", "2001"), ("e", None), ("f", "1999,z,z,3,q"),
             ("g", "1e300,1,1,1"), ("h", "")]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.createDataFrame(lines, "song_id string, value string")
    path = songs.land_checked(df.mapInArrow(count, df.schema), str(tmp_path / "t"))
    assert seen.value == len(lines)
    good = songs.accepted_songs(spark, path)
    bad = songs.rejected_lines(spark, path)
    assert good.columns == ["song_id", "year", "f1", "f2", "f3"] and bad.columns == ["song_id", "rejected_line", "reasons"]
    assert sorted((r.song_id, r.year, r.f1, r.f3) for r in good.collect()) == [
        ("a", 2001, 1.0, 3.0), ("d", 2001, None, None), ("e", None, None, None), ("h", None, None, None)]
    assert sorted((r.song_id, r.rejected_line, r.reasons) for r in bad.collect()) == [
        ("b", "x,1,2,3,9", ["year is not a number"]), ("c", "2001,,y,3", ["f2 is not a number"]),
        ("f", "1999,z,z,3,q", ["f1 is not a number", "f2 is not a number"]), ("g", "1e300,1,1,1", ["year is out of range"])]
    assert "PartitionFilters: [isnotnull(accepted" in good._jdf.queryExecution().toString()


def test_lines_are_checked_in_compiled_code(spark, tmp_path):
    """A projection that is not compiled splits the line anew for each field it names."""
    spark.range(50).select(F.col("id").cast("string").alias("song_id"), F.when(F.col("id") % 5 == 0, "x,1,2,3,4").when(
        F.col("id") % 7 == 0, F.concat_ws(",", F.col("id"), F.lit("y,z"))).otherwise("2001,1,2,,4").alias("value")).write.parquet(str(tmp_path / "in"))
    lines = spark.read.parquet(str(tmp_path / "in"))
    plan = songs.parse_checked(lines)._jdf.queryExecution().executedPlan().toString()
    assert all("*(" in x for x in plan.splitlines() if "Project" in x), plan
    writers = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    path = songs.land_checked(lines.coalesce(1), str(tmp_path / "t"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == writers
    order = [int(r.song_id) for r in songs.rejected_lines(spark, path).select("song_id").collect()]
    assert sorted(order) == [i for i in range(50) if i % 5 == 0 or i % 7 == 0]
    assert songs.accepted_songs(spark, path).count() == 50 - len(order)


# --- nested records ------------------------------------------------------------------

DEEP = """id int, a struct<x: int, b: struct<x: double, y: string>>, c array<struct<x: int, d: array<array<int>>, e: struct<f: string>>>,
          m map<string, struct<v: int>>, s array<string>"""
RECORDS = [(1, (7, (0.5, "q")), [(1, [[1, 2], []], ("u",)), (2, None, None)], {"k": (3,)}, ["p", None]),
           (2, None, [], {}, None), (3, (None, None), None, None, [])]


def test_leaves_of_any_schema(spark):
    df = spark.createDataFrame(RECORDS, DEEP)
    found = [(".".join(x.path), x.type.simpleString(), len(x.arrays)) for x in records.leaves(df.schema)]
    assert found == [("id", "int", 0), ("a.x", "int", 0), ("a.b.x", "double", 0), ("a.b.y", "string", 0), ("c.x", "int", 1),
                     ("c.d", "int", 3), ("c.e.f", "string", 1), ("m.key", "string", 1), ("m.value.v", "int", 1), ("s", "string", 1)]


def test_flatten_any_record(spark):
    df = spark.createDataFrame(RECORDS, DEEP)
    out = records.flatten(df, keep=["id"])
    assert out.columns == ["id", "a_x", "b_x", "y"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 7, 0.5, "q"), (2, None, None, None), (3, None, None, None)]
    assert records.flatten(df.withColumnRenamed("id", "y"), keep=["y"]).columns == ["y", "a_x", "b_x", "b_y"]


def test_unnest_arrays_at_any_depth(spark):
    df = spark.createDataFrame(RECORDS, DEEP).withColumn("_at0", F.lit(1))
    rows = lambda out: sorted((tuple(r) for r in out.collect()), key=str)
    c = records.unnest(df, "c", keep=["id"])
    assert c.columns == ["id", "c_pos", "x", "f"] and rows(c) == [(1, 0, 1, "u"), (1, 1, 2, None)]
    assert rows(records.unnest(df, "c", keep=["id"], outer=True)) == [
        (1, 0, 1, "u"), (1, 1, 2, None), (2, None, None, None), (3, None, None, None)]
    d = records.unnest(df, "c.d", keep=["id"])
    assert d.columns == ["id", "c_pos", "d_pos", "d_pos_inner", "d"]
    assert rows(d) == [(1, 0, 0, 0, 1), (1, 0, 0, 1, 2)]
    assert rows(records.unnest(df, ("m",), keep=["id"])) == [(1, 0, "k", 3)]
    assert rows(records.unnest(df, "s")) == [(0, "p"), (1, None)]
    for path, message in (("a", "is no array"), ("c.zz", "no field c.zz"), ("id.x", "no field id.x")):
        with pytest.raises(ValueError, match=message):
            records.unnest(df, path)


# --- restart points ------------------------------------------------------------------

def make_archive(path, count, seed, level=6, members=1):
    """A tar.gz of ``count`` text members, as ``members`` gzip members; {name: md5}."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    out, buffer = {}, io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w") as tar:
        d = tarfile.TarInfo("folder/")
        d.type = tarfile.DIRTYPE
        tar.addfile(d)
        for i in range(count):
            data = " ".join(r.choices(vocabulary, k=r.choice([0, 5, 400, 3000]))).encode()
            name = ("long/" * 40 if i % 50 == 0 else "") + f"m{i}" + (".h5" if i % 7 else ".txt")
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
            out[name] = hashlib.md5(data).hexdigest()
    raw = buffer.getvalue()
    size = -(-len(raw) // members)
    path.write_bytes(b"".join(gzip.compress(raw[i:i + size], level) for i in range(0, len(raw), size)) + b"\0" * (members == 2) * 100)
    return out


@pytest.mark.parametrize("level,members", [(6, 1), (1, 1), (9, 2), (6, 40)])
def test_one_archive_is_read_by_many_tasks(spark, tmp_path, level, members):
    want = make_archive(tmp_path / "a.tar.gz", 1000, level, level, members)
    index = restart.index_archives(spark, [str(tmp_path / "a.tar.gz")] * 2, spacing=1 << 19)
    index = spark.createDataFrame(index.collect(), restart.INDEX_SCHEMA)
    assert index.count() >= 8
    if members == 1:
        assert {r.bit for r in index.collect()} != {0}  # entered inside bytes
    out = restart.read_indexed(index, None).select("member", "size", F.md5("content").alias("h"), F.spark_partition_id().alias("task"))
    rows = out.collect()
    assert len(rows) == 1000 and {r.member: r.h for r in rows} == want
    assert len({r.task for r in rows}) > 1
    only = restart.read_indexed(index, ".txt", content=False)
    assert only.columns == ["path", "member", "size"] and only.count() == sum(n.endswith(".txt") for n in want)


def test_large_archives_are_split_on_request(spark, tmp_path):
    from cadenza.sources import archive
    want = make_archive(tmp_path / "big.tar.gz", 400, 8) | {}
    small = make_archive(tmp_path / "small.tar.gz", 5, 9)
    paths = [str(tmp_path / "*.tar.gz")]
    for split_over in (None, 100_000, 0):
        rows = archive.read_archives(spark, paths, suffix=None, split_over=split_over).collect()
        assert sorted(hashlib.md5(r.content).hexdigest() for r in rows) == sorted([*want.values(), *small.values()])
    with pytest.raises(ValueError, match="max_members"):
        archive.read_archives(spark, paths, max_members=3, split_over=1)


def test_small_archives_and_ones_that_cannot_be_compressed(spark, tmp_path):
    r = random.Random(1)
    with tarfile.open(tmp_path / "noise.tar.gz", "w:gz") as tar:
        data = r.randbytes(3_000_000)
        info = tarfile.TarInfo("noise.h5")
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))
    with tarfile.open(tmp_path / "none.tar.gz", "w:gz"):
        pass
    want = make_archive(tmp_path / "small.tar.gz", 3, 5)
    paths = [str(tmp_path / f"{n}.tar.gz") for n in ("noise", "none", "small")]
    out = restart.read_indexed(restart.index_archives(spark, paths, spacing=1 << 18), None)
    got = {row.member: hashlib.md5(row.content).hexdigest() for row in out.collect()}
    assert got == want | {"noise.h5": hashlib.md5(data).hexdigest()}


def test_damage_is_noticed(spark, tmp_path):
    path = tmp_path / "a.tar.gz"
    make_archive(path, 600, 3)
    whole = path.read_bytes()
    index = spark.createDataFrame(restart.index_archives(spark, [str(path)], spacing=1 << 19).collect(), restart.INDEX_SCHEMA)
    path.write_bytes(whole[:-5000])
    with pytest.raises(Exception):
        restart.index_archives(spark, [str(path)], spacing=1 << 19).collect()
    with pytest.raises(Exception):
        restart.read_indexed(index, None).collect()
    path.write_bytes(whole)
    wrong = index.withColumn("crc", F.col("crc") + 1)
    with pytest.raises(Exception, match="checksum"):
        restart.read_indexed(wrong, None).collect()


def test_shifted_bits():
    r = random.Random(2)
    data = r.randbytes(50)
    for bit in range(0, 40, 3):
        value = int.from_bytes(data, "little") >> bit
        out = restart.shifted(data, bit)
        assert int.from_bytes(out, "little") == value


def test_block_starts_hold_the_real_ones():
    text = " ".join(random.Random(4).choices(["alpha", "beta", "gamma", "delta", "epsilon"], k=60_000)).encode()
    stream = zlib.compressobj(6, zlib.DEFLATED, -15)
    first = stream.compress(text) + stream.flush(zlib.Z_FULL_FLUSH)
    second = stream.compress(text[::-1]) + stream.flush()
    found = restart.block_starts(first + second)
    assert len(first) * 8 in found or second[0] & 1  # the block after a full flush, unless it is the last
    assert len(found) < len(first + second) * 8 / 200
