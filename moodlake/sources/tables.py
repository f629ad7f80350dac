"""Driver tables and the ``plays`` feed derived from them.

A play is an event mapped onto a song (a document). The mapping uses only
the tables, so its size grows with them:

* song = ``documents.doc_id = events.event_id % count(documents)``
* ``id`` = doc_id as text, ``artist`` = source, ``genre`` = a music genre by
  doc_id (one of five is ``not applicable``, one NULL)
* ``lyrics`` = the text, or the sentinel when the event is an ``error``
  (the lyrics lookup failed)
* ``topic`` (feed): view → global chart, signup → Italian chart,
  anything else → a song played in the player
* ``timestamp`` = event time
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.functions.text import SENTINEL_LYRICS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Feed tags.
FEED_GLOBAL = "song_global_top"
FEED_ITALY = "song_italy_top"
FEED_PLAYED = "song_played"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; the scan's splits set the parallelism
    (``spark.sql.files.maxPartitionBytes``), nothing is shuffled for it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def feed_of(event_type: Column) -> Column:
    return (F.when(event_type == "view", F.lit(FEED_GLOBAL))
            .when(event_type == "signup", F.lit(FEED_ITALY))
            .otherwise(F.lit(FEED_PLAYED)))


# Music genres of the songs, by doc_id; every sixth song has none.
GENRES = ["pop", "rock", "rap", "jazz", "not applicable"]


def music_genre(doc_id: Column) -> Column:
    """A song's music genre (it says nothing about the language of its text)."""
    return F.get(F.array(*[F.lit(g) for g in GENRES]), F.pmod(doc_id, F.lit(len(GENRES) + 1)).cast("int"))


def song_key(events: DataFrame, documents: DataFrame) -> Column:
    """``event_id % count(documents)`` as a scalar subquery (stays lazy)."""
    n = documents.select(F.count(F.lit(1))).scalar()
    return F.pmod(events["event_id"], n)


def spread_time(ts: Column, play_id: Column) -> Column:
    """The events span one month; this deals plays over three."""
    return ts + F.make_dt_interval(days=(play_id % 3 * 31).cast("int"))


def play_keys(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Narrow play facts from ``events`` alone:
    ``play_id, timestamp, user_id, topic, doc_id, lyrics_missing``.
    ``spread`` deals the times over months."""
    ev = table(spark, sf_dir, "events")
    docs = table(spark, sf_dir, "documents")
    time = spread_time(F.col("ts"), F.col("event_id")) if spread else F.col("ts")
    return ev.select(F.col("event_id").alias("play_id"), time.alias("timestamp"),
                     "user_id", feed_of(F.col("event_type")).alias("topic"),
                     song_key(ev, docs).alias("doc_id"),
                     F.coalesce(F.col("event_type") == "error", F.lit(False)).alias("lyrics_missing"))


def plays(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Full play records (the envelope fields plus play id and time). ``parts``
    deals the songs over so many partitions, a song's plays side by side."""
    keys = play_keys(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    if parts:       # dealt before the texts are joined
        keys, docs = keys.repartition(parts, "doc_id").sortWithinPartitions("doc_id"), docs.repartition(parts, "doc_id")
    j = keys.join(docs, "doc_id")
    return j.select(
        "play_id", "timestamp", "user_id", "topic", "doc_id",
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("song "), F.col("doc_id").cast("string")).alias("name"),
        F.col("source").alias("artist"),
        music_genre(F.col("doc_id")).alias("genre"),
        F.when(F.col("lyrics_missing"), F.lit(SENTINEL_LYRICS)).otherwise(F.col("text")).alias("lyrics"),
    )


def song_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct song text a play can carry: each document as written
    and each document whose lyrics were not found.
    ``doc_id, lyrics_missing, genre, artist, lyrics``."""
    docs = table(spark, sf_dir, "documents")
    attrs = ["doc_id", music_genre(F.col("doc_id")).alias("genre"), F.col("source").alias("artist")]
    found = docs.select(*attrs, F.lit(False).alias("lyrics_missing"), F.col("text").alias("lyrics"))
    missing = table(spark, sf_dir, "documents").select(*attrs, F.lit(True).alias("lyrics_missing"),
                          F.lit(SENTINEL_LYRICS).alias("lyrics"))
    return found.unionByName(missing)


# Common words of the documents and the valued or rule words that stand for them in sung texts.
VOICE = {"is": "good", "was": "bad", "with": "not", "the": "very", "by": "but", "that": "hate", "it": "slightly",
         "ist": "gut", "im": "schlecht", "der": "sehr", "als": "aber", "dem": "kaum",
         "est": "bon", "qui": "triste", "le": "très", "sur": "mais",
         "del": "feliz", "con": "malo", "el": "muy", "por": "pero"}


def sung(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, lang, lyrics``: every document with common words read as
    valued and rule words, since invented prose holds none."""
    lyrics = F.col("text")
    for old, new in VOICE.items():
        lyrics = F.replace(lyrics, F.lit(f" {old} "), F.lit(f" {new} "))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", lyrics.alias("lyrics"))
