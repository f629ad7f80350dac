"""S3: paged catalogue captures (lists of nested track items).

A capture is JSON with ``items`` (array of ``{track: {...}}``) per page.
``read_item_pages`` reads such files with an explicit schema; the driver
tables are packed into the same shape by ``pages_from_tables``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.functions.envelope import PAGE_SCHEMA
from moodlake.operators.ranking import row_numbers
from moodlake.sources.tables import table

# Fixed value: items per captured page of a list.
PAGE_SIZE = 50


def read_item_pages(spark: SparkSession, path: str, schema: T.StructType = PAGE_SCHEMA) -> DataFrame:
    """One row per captured page: ``offset`` (page start, 0 when absent)
    and ``items``."""
    fields = list(schema.fields)
    if "offset" not in schema.fieldNames():
        fields.append(T.StructField("offset", T.LongType()))
    df = spark.read.schema(T.StructType(fields)).json(path)
    return df.withColumn("offset", F.coalesce(F.col("offset"), F.lit(0).cast("long")))


def write_item_pages(pages: DataFrame, path: str) -> None:
    """Captured pages as JSON files, one page a line."""
    pages.write.mode("overwrite").json(path)


def assemble_lists(pages: DataFrame, keys: list[str], page_size: int = PAGE_SIZE) -> DataFrame:
    """The pages of each list in front of its first empty or missing page,
    where a reader that asks page after page stops. The cut is the smallest
    page number that follows a filled page (or is 0) and is not filled itself: an anti-join and a
    partial aggregate over page numbers, no list is gathered or numbered."""
    number = F.floor(F.col("offset") / page_size)
    named = pages.withColumn("_page", number)
    filled = named.where(F.size("items") > 0).select(*keys, "_page").distinct()
    after = filled.select(*keys, (F.col("_page") + 1).alias("_page"))
    starts = named.select(*keys).distinct().select(*keys, F.lit(0).cast("long").alias("_page"))
    cut = (after.unionByName(starts).join(filled, [*keys, "_page"], "left_anti")
                .groupBy(*keys).agg(F.min("_page").alias("_cut")))
    return named.join(cut, keys).where("_page < _cut").drop("_page", "_cut")


def pages_from_tables(spark: SparkSession, sf_dir: str, page_size: int = PAGE_SIZE,
                      list_key: str = "l_orderkey") -> DataFrame:
    """Pages of at most ``page_size`` items, one list per order (or per other
    ``list_key`` of the line items): its line
    items as wrapped track items in line order. Track = part, first artist
    = supplier; a returned line ('R') has no album image. Columns
    ``list_id, offset, items``.

    Items are numbered with ``row_numbers`` and packed per (list, page), so every collected array holds at most
    ``page_size`` items however long the list is.
    """
    li = table(spark, sf_dir, "lineitem").select(
        F.col(list_key).alias("list_id"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_returnflag") != "R").alias("_kept"))
    # Number the narrow line rows first (that copy is what gets written),
    # then attach the track attributes.
    numbered = row_numbers(li, ["list_id"], ["l_linenumber", "l_orderkey", "l_partkey", "l_suppkey", "_kept"], out="_rn")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = (numbered.join(part, numbered["l_partkey"] == part["p_partkey"])
                 .join(sup, numbered["l_suppkey"] == sup["s_suppkey"], "left"))
    images = F.when(~F.col("_kept"), F.array().cast("array<struct<url:string>>")) \
        .otherwise(F.array(F.struct(F.concat(F.lit("img/"), F.col("p_brand")).alias("url"))))
    track = F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
                     F.array(F.struct(F.col("s_name").alias("name"))).alias("artists"),
                     F.struct(images.alias("images")).alias("album"))
    paged = j.select("list_id", "_rn", F.struct(track.alias("track")).alias("item"),
                     F.floor((F.col("_rn") - 1) / page_size).cast("long").alias("_page"))
    packed = paged.groupBy("list_id", "_page").agg(
        F.sort_array(F.collect_list(F.struct("_rn", "item"))).alias("_items"))
    return packed.select("list_id", (F.col("_page") * page_size).alias("offset"),
                         F.transform("_items", lambda x: x["item"]).alias("items"))
