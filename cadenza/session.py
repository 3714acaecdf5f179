"""Session helpers: local sessions for tests/bench, shared checkpoint folder.

On a cluster the caller passes its own session; nothing here overrides
settings that are already present.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "cadenza") -> SparkSession:
    """A local session configured like the test/bench harness (UI off, AQE on)."""
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.worker.reuse", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def has_shared_folder(spark: SparkSession) -> bool:
    """Is there a folder for written tables? A local session always gets one."""
    return (_is_local(spark) or bool(spark.sparkContext.getConf().get(_CKPT_KEY, None))
            or spark.sparkContext._jsc.sc().getCheckpointDir().isDefined())


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint folder).
    Only a local session (tests, bench) gets a private temporary folder when
    neither is set; a cluster session without the setting is an error,
    because a machine-local folder would not be visible to other executors.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get(_CKPT_KEY, None) or spark.conf.get(_CKPT_KEY, None)
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not path and jdir.isDefined():
        path = jdir.get()
    if not path:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/NFS) visible to every executor")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cadenza-ckpt-", dir="/tmp"))
        path = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    elif not jdir.isDefined():
        # keep DataFrame.checkpoint() on the same shared folder
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")
