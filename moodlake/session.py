"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every moodlake job relies on. The time zone is pinned because
# the ISO rendering of play times writes a literal 'Z' (UTC marker).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (hundreds of TB of plays). Big shuffles (the
# play table joined back to its songs) start with many partitions and AQE
# coalesces them to the advisory size; small ones (per-song scores, bounds,
# delete sets) shrink to a few partitions or become broadcasts at run time.
SCALE_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(master: str | None = None, app: str = "moodlake",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, scale: bool = False) -> SparkSession:
    """Build (or reuse) a session with the moodlake defaults.

    On a cluster ``master`` stays None and the launcher decides, and
    ``scale=True`` adds ``SCALE_CONF``; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if scale:
        conf.update(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The launcher sets ``spark.checkpoint.dir`` to a shared file system and
    Spark registers it with the context. Only in local mode, where driver and
    executors are one machine, an unset folder is replaced by a scratch one;
    anywhere else executors could not see it, so it is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="moodlake-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def materialize(df, name: str = "table"):
    """Write ``df`` once as parquet below the shared checkpoint folder and
    read it back. Later uses see exactly the written rows (no recompute of
    nondeterministic steps) and the lineage is cut, so a lost executor
    does not replay the upstream stages."""
    import uuid
    path = sub_dir(df.sparkSession, "materialized", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of a write in this block go when the write has ended, not when the driver's
    garbage collector finds them."""
    old = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, old)


def held(df, path: str, partition: str | None = None):
    """``df`` written once to ``path``, below the shared checkpoint folder, and read back; its shuffle files go.
    Rows of each value of ``partition`` lie in a folder of their own."""
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").partitionBy(*([partition] if partition else [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``held`` tables that no plan reads any more."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(fs_path, True)


def sub_dir(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), *parts)
