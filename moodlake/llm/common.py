"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.session import sub_dir

# The six ASCII white-space characters every contract splits on.
SPACES = " \t\n\r\x0b\x0c"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
EXPLAIN = "spark.sql.ui.explainMode"
# Largest Arrow batch sent to a Python worker: whole texts and arrays come by bytes, not by rows.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Set the session's bound of Arrow batches, for plans that run after the operator has returned."""
    spark.conf.set(BATCH, str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Sets the session's bound of Arrow batches."""
    bound_batches(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back:
    later uses see the written rows, and a lost executor replays nothing
    upstream. Shuffle files of the write go when it has ended, the driver
    writes out its plan, again after each stage, in the short form only, and
    Arrow batches are bounded, whoever read the tables."""
    path = sub_dir(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex}")
    conf = df.sparkSession.conf
    old = {k: conf.get(k) for k in (CLEANUP, EXPLAIN, BATCH)}
    bound_batches(df.sparkSession)
    conf.set(CLEANUP, "true")
    conf.set(EXPLAIN, "simple")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in old.items():
            conf.set(k, v)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``materialize`` that no plan reads any more: all that
    was derived from them has been written itself, so a lost executor never needs them again."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (other letters stay as they are)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def per_process(key: str, make):
    """``make()`` once per Python worker process. Tasks get pickled copies of
    their functions, so module globals do not outlive a task; this store does."""
    store = sys.modules.setdefault("_llm_per_process", types.ModuleType("_llm_per_process"))
    if not hasattr(store, key):
        setattr(store, key, make())
    return getattr(store, key)
