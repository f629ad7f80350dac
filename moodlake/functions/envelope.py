"""Envelope, JSON and nested-access functions.

The play envelope is a JSON object with six string fields. One
``from_json`` with an explicit schema replaces six path extractions: a
missing or null field becomes NULL, a malformed record keeps its row with
all fields NULL, and a number or object lands as its JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.functions.text import NOT_APPLICABLE

# Envelope fields in record order, and the transport fields
# the ingest step removes.
ENVELOPE_FIELDS = ["topic", "name", "artist", "lyrics", "genre", "id"]
TRANSPORT_FIELDS = ["@version", "host", "path", "tags", "type", "ecs", "level",
                    "taskName", "logger_name"]

# Placeholder cover when an item has no image (ours; configurable).
DEFAULT_IMAGE = "static/default-cover.jpg"

ENVELOPE_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in
                                ["id", "name", "lyrics", "artist", "topic", "genre"]])

_ARTISTS = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))
_IMAGES = T.ArrayType(T.StructType([T.StructField("url", T.StringType())]))
TRACK_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("artists", _ARTISTS),
    T.StructField("album", T.StructType([T.StructField("images", _IMAGES)])),
])
WRAPPED_ITEM_SCHEMA = T.StructType([T.StructField("track", TRACK_SCHEMA)])
PAGE_SCHEMA = T.StructType([T.StructField("items", T.ArrayType(WRAPPED_ITEM_SCHEMA))])
ARTIST_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("images", _IMAGES),
    T.StructField("followers", T.StructType([T.StructField("total", T.LongType())])),
    T.StructField("popularity", T.LongType()),
    T.StructField("genres", T.ArrayType(T.StringType())),
])


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_frames(df: DataFrame) -> DataFrame:
    """Message bytes to text; the log timestamp is kept."""
    return df.select(F.col("value").cast("string").alias("value"), "timestamp")


def parse_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """The six envelope fields next to the other columns of ``df``."""
    j = F.from_json(F.col(value), ENVELOPE_SCHEMA, {"mode": "PERMISSIVE", "allowUnquotedControlChars": "true"})
    rest = [c for c in df.columns if c != value]
    return df.select(*[j[f].alias(f) for f in ["id", "name", "lyrics", "artist", "topic", "genre"]],
                     *rest)


def to_frames(df: DataFrame) -> DataFrame:
    """K2: every row as one JSON value."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def envelope_value(feed: str | None = None) -> Column:
    """K3 as a column: the play record JSON of the row; ``feed`` overrides
    ``topic``."""
    topic = F.lit(feed) if feed else F.col("topic")
    return F.to_json(F.struct(topic.alias("topic"), *[F.col(f) for f in ENVELOPE_FIELDS[1:]]),
                     {"ignoreNullFields": "false"})


def play_envelope(df: DataFrame, feed: str | None = None, value_only: bool = True) -> DataFrame:
    """K3: build the play record JSON; ``feed`` overrides ``topic``. With
    ``value_only=False`` the non-envelope columns are kept next to ``value``."""
    rec = envelope_value(feed)
    if value_only:
        return df.select(rec.alias("value"))
    return df.select(*[c for c in df.columns if c not in ENVELOPE_FIELDS], rec.alias("value"))


def unwrap_message(df: DataFrame, schema: T.StructType, message: str = "message") -> DataFrame:
    """Parse the JSON in ``message`` into top-level fields and drop it.
    A parsed field replaces a same-named outer one."""
    j = F.from_json(F.col(message), schema)
    inner = [f.name for f in schema.fields]
    outer = [c for c in df.columns if c != message and c not in inner]
    return df.select(*[F.col(f"`{c}`") for c in outer], *[j[f].alias(f) for f in inner])


def drop_transport(df: DataFrame) -> DataFrame:
    """Drop the transport fields that are present."""
    return df.drop(*TRANSPORT_FIELDS)


def first_or_default(arr, field: str, default) -> Column:
    """``arr[0].field`` or ``default`` when the array is empty or NULL."""
    d = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.get(_c(arr), 0)[field], d)


def first_artist(artists) -> Column:
    """P5: name of the first artist (NULL for an empty list)."""
    return F.get(_c(artists), 0)["name"]


def flatten_tracks(items: DataFrame, wrapped: bool = True, item: str = "item",
                   default_image: str = DEFAULT_IMAGE) -> DataFrame:
    """P5: one flat row per item: ``id, name, artist, image``.
    ``wrapped`` items carry the track under ``track``."""
    t = F.col(item)["track"] if wrapped else F.col(item)
    rest = [c for c in items.columns if c != item]
    return items.select(*rest, t["id"].alias("id"), t["name"].alias("name"),
                        first_artist(t["artists"]).alias("artist"),
                        first_or_default(t["album"]["images"], "url", default_image).alias("image"))


def explode_items(pages: DataFrame, items: str = "items", item: str = "item") -> DataFrame:
    """S3 helper: one row per list item with its global ``position``.
    ``pages`` has ``offset`` (the page start) and ``items``."""
    rest = [c for c in pages.columns if c != items]
    ex = pages.select(*rest, F.posexplode(F.col(items)).alias("_pos", item))
    if "offset" in pages.columns:
        ex = ex.withColumn("position", F.col("offset") + F.col("_pos"))
    else:
        ex = ex.withColumn("position", F.col("_pos"))
    return ex.drop("_pos")


def join_genres(arr) -> Column:
    """``"a, b, c"``; an empty list gives ''."""
    return F.array_join(_c(arr), ", ")


def primary_genre(artist) -> Column:
    """Artist missing → NULL; no genres or an empty first genre →
    ``not applicable``; otherwise the first genre."""
    a = _c(artist)
    g0 = F.get(a["genres"], 0)
    return (F.when(a.isNull(), F.lit(None).cast("string"))
            .when(g0.isNull() | (g0 == ""), F.lit(NOT_APPLICABLE))
            .otherwise(g0))


def with_feed(df: DataFrame, tag: str) -> DataFrame:
    """Tag every row with its feed."""
    return df.withColumn("topic", F.lit(tag))


def cards(df: DataFrame, kind: str, *keep: str, default_image: str = DEFAULT_IMAGE) -> DataFrame:
    """P10: album / artist / playlist cards ``name, id, image[, artist]``, song
    cards ``name, image, artist`` (a song's image is its album's, and its card links by name and artist), and the ``keep`` columns."""
    if kind == "song":
        return df.select("name", first_or_default(F.col("album")["images"], "url", default_image).alias("image"),
                         first_artist("artists").alias("artist"), *keep)
    cols = [F.col("name"), F.col("id"),
            first_or_default("images", "url", default_image).alias("image")]
    if kind == "album":
        cols.append(first_artist("artists").alias("artist"))
    elif kind not in ("artist", "playlist"):
        raise ValueError("kind must be album, artist, playlist or song")
    return df.select(*cols, *keep)


def artist_profile(df: DataFrame, *keep: str) -> DataFrame:
    """Name, first image, followers, popularity, genres as text (plus
    the ``keep`` columns)."""
    return df.select("id", "name", F.get(F.col("images"), 0)["url"].alias("image"),
                     F.col("followers")["total"].alias("followers"), "popularity",
                     join_genres("genres").alias("genres"), *keep)
