"""Dashboard plans over the driver tables (the flagship path, §3.4).

``plays → distinct songs scored once → join back → roll up`` is written so
the play table is reduced *before* any join: plays are first counted per
(feed, song, lyrics variant[, day]) — a partial aggregate that collapses a
hot song on the map side — and only those counts meet the song scores.
Both join sides are then bounded by the number of songs, not plays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.functions.text import SENTINEL_LYRICS, sentiment_category
from moodlake.operators import trends
from moodlake.operators.scoring import score_texts
from moodlake.sources.tables import music_genre, play_keys, song_variants, table


def song_scores(spark: SparkSession, sf_dir: str, lexicon: DataFrame | None = None) -> DataFrame:
    """Scores of every song variant: ``doc_id, lyrics_missing, compound,
    sentiment, emotion``. Grouped by the join key alone, so the scores are
    already hash-partitioned the way the join with the play counts needs."""
    v = song_variants(spark, sf_dir)
    return score_texts(v, ["doc_id", "lyrics_missing"], "lyrics", lang=None, lexicon=lexicon,
                       negation=True, contrast=True, intensity=True)


def weighted_plays(spark: SparkSession, sf_dir: str, by_day: bool = False,
                   lexicon: DataFrame | None = None, spread: bool = False) -> DataFrame:
    """Scored plays, pre-aggregated: one row per (feed, song variant[, day])
    with ``plays`` = number of plays it stands for."""
    keys = play_keys(spark, sf_dir, spread)
    group = ["topic", "doc_id", "lyrics_missing"]
    if by_day:
        keys = keys.withColumn("day", F.to_date("timestamp"))
        group.append("day")
    counts = keys.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    scored = counts.join(song_scores(spark, sf_dir, lexicon), ["doc_id", "lyrics_missing"])
    lyrics = F.when(F.col("lyrics_missing"), F.lit(SENTINEL_LYRICS))
    return scored.withColumn("sentiment_category", sentiment_category(lyrics, F.col("compound")))


def mood_counts(spark, sf_dir, lexicon=None):
    return trends.mood_counts(weighted_plays(spark, sf_dir, lexicon=lexicon), weight="n")


def category_counts(spark, sf_dir, lexicon=None):
    return trends.category_counts(weighted_plays(spark, sf_dir, lexicon=lexicon), weight="n")


def mood_board(spark, sf_dir, lexicon=None):
    """Flagship: plays per feed, sentiment category and emotion."""
    return trends.counts_by(weighted_plays(spark, sf_dir, lexicon=lexicon),
                            ["topic", "sentiment_category", "emotion"], weight="n")


def genre_counts(spark, sf_dir):
    # Genre and artist need no scores: count plays per song, then join the
    # song attributes (both sides bounded by the number of songs).
    counts = play_keys(spark, sf_dir).groupBy("topic", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    docs = table(spark, sf_dir, "documents").select("doc_id", music_genre(F.col("doc_id")).alias("genre"))
    return trends.genre_counts(counts.join(docs, "doc_id"), weight="n")


def artist_counts(spark, sf_dir):
    counts = play_keys(spark, sf_dir).groupBy("topic", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("artist"))
    return trends.artist_counts(counts.join(docs, "doc_id"), weight="n")


def top_artists(spark, sf_dir, n: int = 5):
    return trends.top_n(artist_counts(spark, sf_dir), "artist", n, partition="topic")


def taste_trend(spark, sf_dir, grain: str, lexicon=None, spread: bool = False):
    wp = weighted_plays(spark, sf_dir, by_day=True, lexicon=lexicon, spread=spread)
    return trends.taste_trend(wp, grain, dim="emotion", weight="n", bucket="day")


def attribute_trend(spark, sf_dir, grain: str, attribute: str = "genre", spread: bool = False):
    """A4 by a song attribute (genre or artist): plays per period, feed
    and attribute. Plays are counted per (feed, song, day) first; only
    those counts meet the song attributes."""
    keys = play_keys(spark, sf_dir, spread).withColumn("day", F.to_date("timestamp"))
    counts = keys.groupBy("topic", "doc_id", "day").agg(F.count(F.lit(1)).alias("n"))
    value = music_genre(F.col("doc_id")) if attribute == "genre" else F.col("source")
    docs = table(spark, sf_dir, "documents").select("doc_id", value.alias(attribute))
    return trends.taste_trend(counts.join(docs, "doc_id"), grain, dim=attribute, weight="n", bucket="day")


def genre_trend(spark, sf_dir, grain: str):
    return attribute_trend(spark, sf_dir, grain, "genre")
