"""L2: paging through a long ordered list by a stored order index.

``build_page_index`` stores a sorted copy of the list, range-partitioned by
the order, each row with its place in its partition, and the number of rows
of every partition. A page is found by the counts alone: ``read_page`` reads
the partitions that hold it, and in those only the row groups of its places,
whatever the offset.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Items per page, and the offset of the last page that is asked for.
PAGE_LIMIT = 50
LAST_OFFSET = 950


def build_page_index(df: DataFrame, order: list[str], path: str, partitions: int | None = None) -> str:
    """Store ``df`` in ``order`` below ``path`` (equal rows of the order: any fixed order among them)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in df.columns if c not in order]
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))     # record number in its partition
    rows = (df.repartitionByRange(n, *order, *rest).sortWithinPartitions(*order, *rest)
              .select("*", F.spark_partition_id().alias("_part"), place.alias("_place")))
    rows.write.mode("overwrite").partitionBy("_part").parquet(os.path.join(path, "rows"))
    stored = _rows(spark, path, df.schema)
    (stored.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).coalesce(1)
           .write.mode("overwrite").parquet(os.path.join(path, "counts")))
    return path


def _rows(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    where = os.path.join(path, "rows")
    schema = schema or T.StructType([f for f in spark.read.parquet(where).schema if f.name not in ("_part", "_place")])
    return spark.read.schema(T.StructType(
        [*schema, T.StructField("_place", T.LongType()), T.StructField("_part", T.IntegerType())])).parquet(where)


def read_page(spark: SparkSession, path: str, offset: int, limit: int = PAGE_LIMIT) -> DataFrame:
    """The rows at ``offset`` to ``offset + limit`` with their ``position`` (from 0); past the end, none."""
    start, parts = 0, []
    for r in spark.read.parquet(os.path.join(path, "counts")).orderBy("_part").collect():    # a row per partition
        if start < offset + limit and start + r.n > offset:
            parts.append((r._part, start))
        start += r.n
    rows = _rows(spark, path)
    here, position = F.lit(False), F.lit(None).cast("long")
    for part, first in parts:
        low, high = max(offset - first, 0), offset + limit - first
        here = here | ((F.col("_part") == part) & (F.col("_place") >= low) & (F.col("_place") < high))
        position = F.when(F.col("_part") == part, F.col("_place") + first).otherwise(position)
    return rows.where(F.col("_part").isin([p for p, _ in parts]) & here).withColumn("position", position).drop("_part", "_place")


def read_pages(spark: SparkSession, path: str, limit: int = PAGE_LIMIT, last_offset: int = LAST_OFFSET) -> DataFrame:
    """Pages 0, 1, … up to the one at ``last_offset``, concatenated until the
    first empty one. Pages of a gapless list are empty from its end on, so
    this is one read of the places below the last page's end."""
    rows = read_page(spark, path, 0, last_offset + limit)
    return rows.withColumn("page", F.floor(F.col("position") / limit))
