"""The daily chart harvest as one batch job per chart.

chart list → number items (W4) → lyrics lookup (J1: clean title, validity
gate, first-line cut, miss → sentinel) → genre lookup (J2: first artist
hit, primary genre) → feed tag (P9) → play envelope (K3); both charts are
then merged (U1). Over the driver tables a chart is the 50 most played
songs of its feed (the cap is the chart's own size), the lyrics dimension
is the documents and an artist's genres are the languages of its songs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.functions import envelope as env
from moodlake.operators import library as lib
from moodlake.operators import lookup, trends
from moodlake.sources.tables import FEED_GLOBAL, FEED_ITALY, play_keys, table

# Fixed value: items per chart playlist.
CHART_SIZE = 50


def harvest_chart(items: DataFrame, lyrics_dim: DataFrame, artists_dim: DataFrame, feed: str) -> DataFrame:
    """One chart: ``items`` (``item_number, id, name, artist``) → envelope
    rows ``topic, item_number, id, name, artist, lyrics, genre, value``."""
    with_lyrics = lookup.with_lyrics(items, lyrics_dim)
    with_genre = lookup.with_genre(with_lyrics, artists_dim)
    tagged = env.with_feed(with_genre, feed)
    return tagged.withColumn("value", env.envelope_value())


def chart_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (play_keys(spark, sf_dir).filter(F.col("topic").isin(FEED_GLOBAL, FEED_ITALY))
              .groupBy("topic", "doc_id").agg(F.count(F.lit(1)).alias("plays")))
    charts = trends.top_n(counts, "doc_id", CHART_SIZE, partition="topic")
    docs = table(spark, sf_dir, "documents")
    lyrics_dim = docs.select(F.concat(F.lit("song "), F.col("doc_id").cast("string")).alias("title"),
                             F.col("source").alias("artist"), F.col("doc_id").alias("rank"),
                             F.col("text").alias("lyrics"))
    artists_dim = (table(spark, sf_dir, "documents").groupBy("source")
                   .agg(F.sort_array(F.collect_set("lang")).alias("genres"))
                   .select(F.col("source").alias("name"), "genres", F.lit(0).alias("rank")))
    song_attrs = table(spark, sf_dir, "documents").select("doc_id", "source")
    parts = []
    for feed in (FEED_GLOBAL, FEED_ITALY):
        items = (charts.filter(F.col("topic") == feed).join(song_attrs, "doc_id")
                 .select(F.col("rank").alias("item_number"), F.col("doc_id").cast("string").alias("id"),
                         F.concat(F.lit("song "), F.col("doc_id").cast("string")).alias("name"),
                         F.col("source").alias("artist")))
        parts.append(harvest_chart(items, lyrics_dim, artists_dim, feed))
    merged = lib.append_pages(*parts)
    return merged.select("topic", "item_number", "id", "name", "artist", "genre",
                         F.md5("lyrics").alias("lyrics_md5"), F.md5("value").alias("value_md5"))
