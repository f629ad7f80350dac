"""Filters and predicates (F1-F6) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.functions.text import is_present, validate_lyrics  # noqa: F401  (F4, F5)


def match_track(name: str, artist: str, name_col: str = "name",
                artist_col: str = "artist") -> Column:
    """track name and first artist both equal."""
    return (F.col(name_col) == name) & (F.col(artist_col) == artist)


def by_artist(df: DataFrame, artist: str) -> DataFrame:
    """library entries of one artist."""
    return df.filter(F.col("artist") == artist)


def by_container(df: DataFrame, kind: str, name: str) -> DataFrame:
    """the entries of one album or playlist."""
    return df.filter((F.col("kind") == kind) & (F.col("container") == name))


def by_feed(df: DataFrame, tag: str) -> DataFrame:
    """one feed's rows (one dashboard per feed)."""
    return df.filter(F.col("topic") == tag)
