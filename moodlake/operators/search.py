"""Catalogue search and top tracks (L1, L3, L5) and offset paging (L2).

Relevance is ours: case-insensitive containment, ranked exact > prefix >
contains, then name and id. Per-kind caps use ``row_number() <= cap``,
which Catalyst turns into a partial group limit before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Result caps per entity kind.
DEFAULT_CAPS = {"artist": 12, "album": 12, "song": 10, "playlist": 12}


def relevance(name: Column, query: str) -> Column:
    n, q = F.lower(name), F.lit(query.lower())
    return (F.when(n == q, F.lit(0)).when(F.startswith(n, q), F.lit(1))
            .when(F.contains(n, q), F.lit(2)))


def search(catalogs: dict[str, DataFrame], query: str,
           caps: dict[str, int] | None = None) -> DataFrame:
    """L1 / L3: each catalogue (``id, name``) filtered by the query and
    capped per kind; result ``kind, id, name, relevance, rank``."""
    caps = caps or DEFAULT_CAPS
    parts = []
    for kind, df in catalogs.items():
        if kind not in caps:
            continue
        hits = df.select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id"),
                         "name", relevance(F.col("name"), query).alias("relevance"))
        hits = hits.filter(F.col("relevance").isNotNull())
        # A literal cap per kind: the top-k runs as a partial limit per task.
        top = hits.orderBy("relevance", "name", "id").limit(caps[kind])
        w = Window.orderBy("relevance", "name", "id")
        parts.append(top.withColumn("rank", F.row_number().over(w).cast("long")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def page(df: DataFrame, order: list, offset: int, limit: int = 50) -> DataFrame:
    """L2: one page of an ordered list (top-k of offset + limit, then skip)."""
    return df.orderBy(*order).offset(offset).limit(limit)


# Fixed value: market of an artist's top tracks.
MARKET = "IT"


def artist_top_tracks(plays: DataFrame, n: int = 10, market: str | None = MARKET,
                      markets: str = "markets") -> DataFrame:
    """Per artist, its ``n`` most played tracks among those whose array
    of ``markets`` holds ``market`` (None: all): play count desc, then track id.
    Result ``artist, track_id, name, plays, rank``."""
    src = plays.filter(F.array_contains(markets, market)) if market else plays
    counts = src.groupBy("artist", "track_id").agg(F.count(F.lit(1)).alias("plays"),
                                                   F.min("name").alias("name"))
    w = Window.partitionBy("artist").orderBy(F.col("plays").desc(), F.col("track_id"))
    return counts.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= n)


# Fixed value: albums listed on an artist page.
ARTIST_ALBUMS = 50


def artist_albums(albums: DataFrame, n: int = ARTIST_ALBUMS, newest: str = "released") -> DataFrame:
    """L5 (albums): per artist, its ``n`` newest albums (then by album id).
    ``albums`` holds album cards (``artist, id, name, image``) and a
    ``newest`` date column. Adds ``rank``."""
    w = Window.partitionBy("artist").orderBy(F.col(newest).desc(), F.col("id"))
    return albums.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= n)
