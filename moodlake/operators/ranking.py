"""Row numbers and first-match without a window over a whole group.

``Window.partitionBy(k)`` sends every row of a key to one task; a hot
playlist or feed can hold a third of the table. These helpers keep each
task bounded:

* ``first_per_key`` — a ``min`` over a struct led by the order key: a
  partial aggregate, so a hot key is folded on the map side.
* ``sequence_number`` — range-partition by (key, order), number rows inside
  each partition with ``monotonically_increasing_id`` (partition id in the
  upper bits, record number in the lower 33 bits, as documented), write
  that once to the shared checkpoint folder, then add the count of the same
  key's rows in earlier partitions. A hot key simply spans several range
  partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.session import materialize


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """W3 / keep-first: the row with the smallest ``order`` per key (ties
    broken by the remaining columns), as one partial aggregate."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return agg.select(*keys, *[F.col("_first")[f"_o{i}"].alias(c) for i, c in enumerate(order)],
                      *[F.col("_first")[c].alias(c) for c in rest]).select(*df.columns)


def sequence_number(df: DataFrame, partition_by: list[str], order_by: list, out: str = "rn",
                    num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by … order by …)`` computed without
    gathering a key into one task. ``order_by`` must be unique per key for
    a deterministic result (as with any row number)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in partition_by]
    orders = [_col(c) for c in order_by]
    ranged = (df.repartitionByRange(n, *keys, *orders)
                .sortWithinPartitions(*keys, *orders)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    # Range bounds come from a sample of the input, and the input's row
    # order may differ between evaluations (e.g. after a join), so the
    # numbered rows are written once and both uses below read that copy.
    ranged = materialize(ranged, "sequence")
    stats = ranged.groupBy("_pid", *partition_by).agg(F.count(F.lit(1)).alias("_cnt"),
                                                      F.min("_mid").alias("_m0"))
    # Each key spans only the partitions its range covers, so this window
    # holds at most num_partitions rows per key.
    w = Window.partitionBy(*partition_by).orderBy("_pid")
    stats = stats.withColumn("_off", F.sum("_cnt").over(w) - F.col("_cnt")).drop("_cnt")
    stats = stats.select(F.col("_pid").alias("_spid"),
                         *[F.col(c).alias(f"_sk{i}") for i, c in enumerate(partition_by)],
                         "_off", "_m0")
    # No hint: AQE sees the real size of stats and broadcasts it when small.
    cond = [F.col("_pid") == F.col("_spid")] + [
        F.col(c).eqNullSafe(F.col(f"_sk{i}")) for i, c in enumerate(partition_by)]
    j = ranged.join(stats, cond)
    rn = F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1
    return j.select(*df.columns, rn.alias(out))


def row_numbers(df: DataFrame, partition_by: list[str], order_by: list, out: str = "rn") -> DataFrame:
    """``row_number()`` per group by ``sequence_number``: one plan at every
    size, a group of any size is spread over many tasks. As with any row
    number, ``order_by`` must be unique per group."""
    return sequence_number(df, partition_by, order_by, out=out)
