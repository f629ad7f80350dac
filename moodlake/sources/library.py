"""The offline library listing, from files or from the driver tables.

On disk the library is ``songs/<file>``, ``albums/<album>/<file>`` and
``playlists/<playlist>/<file>`` with ``<file> = <name> - <artist>.mp3``.
``read_library`` lists it with the ``binaryFile`` source, selecting only
``path`` so no file content is read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.sources.tables import table

LISTING_COLUMNS = ["kind", "container", "file_name", "path"]


def read_library(spark: SparkSession, root: str) -> DataFrame:
    """List ``*.mp3`` files below ``root`` (recursively); ``path`` is the
    path relative to ``root``. File contents are never loaded."""
    # Spark reports absolute paths ("file:/…" for local files): list and
    # compare against the absolute root (resolved here, not in the JVM, whose
    # working folder may differ), without the scheme for local folders.
    local = "://" not in root
    base = os.path.abspath(root.replace("file:", "")) if local else root
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.mp3").load(base).select("path"))
    prefix = base.rstrip("/") + "/"
    path = F.regexp_replace(F.col("path"), r"^file:", "") if local else F.col("path")
    rel = F.regexp_replace(path, "^" + _regex_quote(prefix), "")
    parts = F.split(rel, "/")
    kind = F.get(parts, 0)
    container = F.when(F.size(parts) >= 3, F.get(parts, 1))
    return files.select(kind.alias("kind"), container.alias("container"),
                        F.element_at(parts, -1).alias("file_name"), rel.alias("path"))


def _regex_quote(s: str) -> str:
    import re
    return re.escape(s)


def song_file(name, artist) -> "F.Column":
    return F.concat(name, F.lit(" - "), artist, F.lit(".mp3"))


def library_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library the driver tables describe:

    * songs: every part, ``<p_name> - <p_brand>.mp3``; parts of type SMALL
      carry a second separator (``… - <p_brand> - SMALL.mp3``)
    * albums: one album per order (``album-<l_orderkey>``) with its parts
    * playlists: one playlist per order priority with the parts ordered
    """
    part = table(spark, sf_dir, "part")
    artist = F.when(F.col("p_type") == "SMALL",
                    F.concat(F.col("p_brand"), F.lit(" - "), F.col("p_type"))).otherwise(F.col("p_brand"))
    files = part.select("p_partkey", song_file(F.col("p_name"), artist).alias("file_name"))
    songs = files.select(F.lit("songs").alias("kind"), F.lit(None).cast("string").alias("container"),
                         "file_name")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    albums = (li.join(files, li["l_partkey"] == files["p_partkey"])
                .select(F.lit("albums").alias("kind"),
                        F.concat(F.lit("album-"), F.col("l_orderkey").cast("string")).alias("container"),
                        "file_name"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    playlists = (li.join(orders, li["l_orderkey"] == orders["o_orderkey"])
                   .join(files, li["l_partkey"] == files["p_partkey"])
                   .select(F.lit("playlists").alias("kind"), F.col("o_orderpriority").alias("container"),
                           "file_name"))
    lib = songs.unionByName(albums).unionByName(playlists).distinct()
    return lib.withColumn("path", F.concat_ws("/", "kind", "container", "file_name"))
