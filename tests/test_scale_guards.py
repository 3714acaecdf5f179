"""Static guards on the library code: no lineage cuts that lose data on
executor loss, no cross joins or unchecked broadcasts, no RDD API, and
driver collections only where they fetch bounded aggregate results."""

import re
from pathlib import Path

LIB = Path(__file__).resolve().parents[1] / "cadenza"
SOURCES = {p: p.read_text() for p in LIB.rglob("*.py") if "llm" not in p.relative_to(LIB).parts}


def _hits(pattern):
    rx = re.compile(pattern)
    return [(p.relative_to(LIB).as_posix(), i + 1)
            for p, text in SOURCES.items()
            for i, line in enumerate(text.splitlines())
            if rx.search(line) and not line.lstrip().startswith("#")]


def test_no_local_checkpoint_or_cross_join():
    assert _hits(r"localCheckpoint|crossJoin") == []


def test_group_counts_are_broadcast_only_when_small(spark, monkeypatch):
    """The archive packer's one join: by broadcast within the bound, by shuffle beyond."""
    from pyspark.sql import functions as F

    from cadenza.sources import archive
    df = spark.range(200).select((F.col("id") % 5).alias("g"), F.col("id").cast("string").alias("n"),
                                 F.lit("x").alias("c"))
    for bound, hinted in ((archive.BROADCAST_MAX_GROUPS, True), (2, False)):
        monkeypatch.setattr(archive, "BROADCAST_MAX_GROUPS", bound)
        packed = archive.pack_archives(df, "g", "n", "c")
        assert ("strategy=broadcast" in packed._jdf.queryExecution().analyzed().toString()) is hinted
        assert packed.count() == 5


def test_rdd_api_only_for_partition_counts():
    hits = _hits(r"\.rdd\b")
    assert all(f == "plans/fixtures.py" for f, _ in hits), hits
    assert "getNumPartitions" in SOURCES[LIB / "plans" / "fixtures.py"]


def test_driver_collections_are_bounded_aggregates():
    # each collect() fetches grouped sums (at most max_groups groups, or d + 4 cells), one
    # merged state of given size, or the folds or the grid of a search
    for f, _ in _hits(r"\.collect\(\)"):
        assert f in ("operators/stats.py", "operators/gd.py", "operators/tuning.py", "operators/wide.py"), f
    assert _hits(r"toPandas\(") == []


def test_group_count_guard(spark):
    import pytest
    from pyspark.sql import functions as F

    from cadenza.operators.stats import moments
    for d in (2, 9):
        df = spark.range(100).select(F.col("id").alias("g"), F.lit(1.0).alias("y"),
                                     F.array(*[F.rand(i) for i in range(d)]).alias("x"))
        with pytest.raises(ValueError, match="more than 50 groups"):
            moments(df, "x", "y", by="g", max_groups=50)


def test_a_row_group_is_dealt_out_before_lines_are_derived(spark, tmp_path):
    """One task reads a whole row group, so the number of splits does not tell how rows are spread."""
    from pyspark.sql import functions as F

    from cadenza.plans import fixtures as fx
    n, d = 20_000, str(tmp_path / "one")
    rows = spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 7).cast("int").alias("l_linenumber"), F.lit(3).cast("long").alias("l_partkey"),
        F.when(F.col("id") % 3 > 0, F.lit(5).cast("long")).alias("l_suppkey"), (F.col("id") % 50).cast("double").alias("l_quantity"),
        F.lit(1.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"), F.lit(0.02).alias("l_tax"))
    rows.coalesce(1).write.parquet(f"{d}/lineitem.parquet")
    rows.repartition(4).write.parquet(f"{tmp_path}/even/lineitem.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        assert fx.table(spark, d, "lineitem").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        lines = fx.song_lines(spark, d)
        plan = fx.derive_song_lines(spark, d, fx.spread)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    sizes = [r["count"] for r in lines.groupBy("_metadata.file_name").count().toLocalIterator()]
    assert sum(sizes) == n and max(sizes) * spark.sparkContext.defaultParallelism <= 2 * n, sizes
    assert "concat_ws" in plan.split("Exchange")[0] and "concat_ws" not in plan.split("Exchange")[1], plan
    assert lines.exceptAll(fx.derive_song_lines(spark, d)).count() == 0
    assert fx.spread(spark, f"{tmp_path}/even", "lineitem")._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
