"""Queries over stored indexes and captures: search cards, deep pages, track
lookups, lists of several pages. Each builds what it reads below the shared
checkpoint folder from the whole driver tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.functions import envelope as env
from moodlake.functions.envelope import DEFAULT_IMAGE, PAGE_SCHEMA, TRACK_SCHEMA
from moodlake.operators import library as lib
from moodlake.operators import paging
from moodlake.operators.search_index import CARD, build_index, search_index
from moodlake.session import sub_dir
from moodlake.sources.frames import read_json_lines
from moodlake.sources.pages import PAGE_SIZE, assemble_lists, pages_from_tables, read_item_pages, write_item_pages
from moodlake.sources.tables import table

# Fixed parameters of the queries: terms that hit every kind and reach every cap, and one that hits nothing.
TERMS = ["u", "blue", "album-12", "Customer#0000001", "no such name"]
DEEP_OFFSET = 12_345
LOOKUP_LIST = 7
LOOKUPS = ["red widget", "blue bolt", "no such song"]
GAP_PAGE, EMPTY_PAGE = 5, 7      # pages that every third list misses, and that every third has empty


def _dir(spark: SparkSession, name: str) -> str:
    return sub_dir(spark, "indexes", f"{name}-{uuid.uuid4().hex[:12]}")


def _image(url, missing):
    return F.when(missing, F.lit(DEFAULT_IMAGE)).otherwise(F.concat(F.lit("img/"), url))


def catalogs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Cards of the four kinds: suppliers, orders, parts and customers."""
    s, o = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "orders")
    p, c = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    album = F.concat(F.lit("album-"), F.col("o_orderkey").cast("string"))
    return {
        "artist": s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                           _image(F.col("s_name"), F.col("s_acctbal") < 0).alias("image")),
        "album": o.join(c, o["o_custkey"] == c["c_custkey"], "left").select(
            F.col("o_orderkey").alias("id"), album.alias("name"), _image(album, F.col("o_orderstatus") == "F").alias("image"),
            F.col("c_name").alias("artist")),
        "song": p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                         _image(F.col("p_brand"), F.col("p_type") == "SMALL").alias("image"), F.col("p_brand").alias("artist")),
        "playlist": c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                             _image(F.col("c_name"), F.col("c_acctbal") < 0).alias("image")),
    }


def search_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 over the stored index: the result cards of several terms."""
    path = build_index(catalogs(spark, sf_dir), _dir(spark, "search"))
    parts = [search_index(spark, path, t).select(F.lit(t).alias("term"), *CARD, "relevance", "rank") for t in TERMS]
    return lib.append_pages(*parts)


def _order_index(spark: SparkSession, sf_dir: str) -> str:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return paging.build_page_index(o, ["o_orderdate", "o_orderkey"], _dir(spark, "pages"))


def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 far into the list."""
    return paging.read_page(spark, _order_index(spark, sf_dir), DEEP_OFFSET)


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: all pages that are asked for, until the first empty one."""
    return paging.read_pages(spark, _order_index(spark, sf_dir)).select("page", "position", "o_orderkey")


def artist_pages(spark: SparkSession, sf_dir: str, path: str) -> None:
    """One list per supplier of all its line items, captured as page files;
    odd lists hold bare items. Some lists have a page missing or empty."""
    pages = pages_from_tables(spark, sf_dir, list_key="l_suppkey")
    page = F.floor(F.col("offset") / PAGE_SIZE)
    pages = pages.where(~((F.col("list_id") % 3 == 0) & (page == GAP_PAGE)))
    none = F.filter("items", lambda x: F.lit(False))
    pages = pages.withColumn("items", F.when((F.col("list_id") % 3 == 1) & (page == EMPTY_PAGE), none).otherwise(F.col("items")))
    write_item_pages(pages.where("list_id % 2 = 0"), f"{path}/wrapped")
    bare = pages.where("list_id % 2 = 1").withColumn("items", F.transform("items", lambda x: x["track"]))
    write_item_pages(bare, f"{path}/bare")


def read_artist_lists(spark: SparkSession, path: str) -> DataFrame:
    """Items of the assembled lists, wrapped and bare, flat."""
    key = T.StructField("list_id", T.LongType())
    parts = []
    for wrapped in (True, False):
        schema = PAGE_SCHEMA if wrapped else T.StructType([T.StructField("items", T.ArrayType(TRACK_SCHEMA))])
        pages = read_item_pages(spark, f"{path}/{'wrapped' if wrapped else 'bare'}", T.StructType([key, *schema]))
        parts.append(env.flatten_tracks(env.explode_items(assemble_lists(pages, ["list_id"])), wrapped=wrapped))
    return lib.append_pages(*parts)


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _dir(spark, "captures")
    artist_pages(spark, sf_dir, path)
    return read_artist_lists(spark, path)


def assembled_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + P5 + U3: lists of several captured pages, up to their first empty or missing page."""
    return _lists(spark, sf_dir).select("list_id", "position", "id", "name", "artist", "image")


def paged_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Circular neighbours across page borders."""
    items = _lists(spark, sf_dir).select("list_id", "position", "id")
    return lib.circular_neighbors(items, ["list_id"], "position", fields=["id"]).select(
        "list_id", "position", "id", "prev_id", "next_id")


def neighbors_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + W3 for single tracks of one list, one of them not in it."""
    items = _lists(spark, sf_dir).where(F.col("list_id") == LOOKUP_LIST)
    artist = f"Supplier#{LOOKUP_LIST:09d}"
    return lib.append_pages(*[lib.neighbors_of(items, name, artist) for name in LOOKUPS])


def song_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: song cards of every list item."""
    items = env.explode_items(pages_from_tables(spark, sf_dir)).select("item.track.*")
    return env.cards(items, "song")


def ingest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + P3 + P4: events as log lines in files, read back as text and unwrapped."""
    path = _dir(spark, "lines")
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "props", F.lit("player").alias("host"))
    env.to_frames(ev).select("value").write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("props", T.StringType()), T.StructField("host", T.StringType())])
    return env.drop_transport(env.unwrap_message(read_json_lines(spark, path), schema))


def queries() -> dict:
    return {f.__name__: f for f in (search_cards, deep_page, all_pages, assembled_lists, paged_neighbors, neighbors_of,
                                    song_cards, ingest_lines)}


# --- the same in DuckDB SQL ------------------------------------------------------

_COVER = f"'{DEFAULT_IMAGE}'"

_LISTS = f"""numbered AS (
  SELECT l.l_suppkey AS list_id, l.l_partkey, l.l_suppkey, l.l_returnflag <> 'R' AS kept,
         row_number() OVER (PARTITION BY l.l_suppkey
                            ORDER BY l.l_linenumber, l.l_orderkey, l.l_partkey, l.l_returnflag <> 'R') - 1 AS position
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
ends AS (SELECT list_id, CASE WHEN list_id % 3 = 0 THEN {GAP_PAGE * PAGE_SIZE} WHEN list_id % 3 = 1 THEN {EMPTY_PAGE * PAGE_SIZE}
           ELSE max(position) + 1 END AS stop FROM numbered GROUP BY list_id),
items AS (SELECT n.list_id, n.position, CAST(p.p_partkey AS VARCHAR) AS id, p.p_name AS name, s.s_name AS artist,
         CASE WHEN n.kept THEN 'img/' || p.p_brand ELSE {_COVER} END AS image
  FROM numbered n JOIN ends e ON e.list_id = n.list_id AND n.position < e.stop
  JOIN part p ON p.p_partkey = n.l_partkey LEFT JOIN supplier s ON s.s_suppkey = n.l_suppkey)"""


def queries_sql() -> dict[str, str]:
    cards = f"""cards AS (
  SELECT 'artist' AS kind, 12 AS cap, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name,
         CASE WHEN s_acctbal < 0 THEN {_COVER} ELSE 'img/' || s_name END AS image, NULL AS artist FROM supplier
  UNION ALL SELECT 'album', 12, CAST(o_orderkey AS VARCHAR), 'album-' || o_orderkey,
         CASE WHEN o_orderstatus = 'F' THEN {_COVER} ELSE 'img/album-' || o_orderkey END, c_name
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey
  UNION ALL SELECT 'song', 10, CAST(p_partkey AS VARCHAR), p_name,
         CASE WHEN p_type = 'SMALL' THEN {_COVER} ELSE 'img/' || p_brand END, p_brand FROM part
  UNION ALL SELECT 'playlist', 12, CAST(c_custkey AS VARCHAR), c_name,
         CASE WHEN c_acctbal < 0 THEN {_COVER} ELSE 'img/' || c_name END, NULL FROM customer)"""
    terms = ", ".join(f"('{t}')" for t in TERMS)
    side = """SELECT name, artist, image, prev_name, prev_artist, next_name, next_artist FROM w
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY position) = 1"""
    names = ", ".join(f"('{n}')" for n in LOOKUPS)
    return {
        "search_cards": f"""WITH {cards}, terms(term) AS (VALUES {terms}),
hits AS (SELECT term, kind, cap, id, name, image, artist, CASE WHEN lower(name) = lower(term) THEN 0
         WHEN starts_with(lower(name), lower(term)) THEN 1 ELSE 2 END AS relevance
  FROM cards JOIN terms ON contains(lower(name), lower(term)))
SELECT term, kind, id, name, image, artist, relevance, rank FROM (SELECT *,
  row_number() OVER (PARTITION BY term, kind ORDER BY relevance, name, id) AS rank FROM hits) WHERE rank <= cap""",
        "deep_page": f"""SELECT o_orderkey, o_orderdate, o_totalprice, position FROM (SELECT o_orderkey, o_orderdate, o_totalprice,
  row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders)
ORDER BY position LIMIT {paging.PAGE_LIMIT} OFFSET {DEEP_OFFSET}""",
        "all_pages": f"""SELECT position // {paging.PAGE_LIMIT} AS page, position, o_orderkey FROM (SELECT o_orderkey,
  row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders)
WHERE position < {paging.LAST_OFFSET + paging.PAGE_LIMIT}""",
        "assembled_lists": f"WITH {_LISTS}\nSELECT list_id, position, id, name, artist, image FROM items",
        "paged_neighbors": f"""WITH {_LISTS}
SELECT list_id, position, id,
  coalesce(lag(id) OVER w, last_value(id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS prev_id,
  coalesce(lead(id) OVER w, first_value(id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_id
FROM items WINDOW w AS (PARTITION BY list_id ORDER BY position)""",
        "neighbors_of": f"""WITH {_LISTS},
w AS (SELECT name, artist, image, position,
  coalesce(lag(name) OVER o, last_value(name) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS prev_name,
  coalesce(lag(artist) OVER o, last_value(artist) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS prev_artist,
  coalesce(lead(name) OVER o, first_value(name) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_name,
  coalesce(lead(artist) OVER o, first_value(artist) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_artist
  FROM items WHERE list_id = {LOOKUP_LIST} WINDOW o AS (ORDER BY position)),
one AS ({side})
SELECT n.name, 'Supplier#{LOOKUP_LIST:09d}' AS artist, coalesce(one.image, {_COVER}) AS image,
  coalesce(prev_name, '') AS prev_name, coalesce(prev_artist, '') AS prev_artist,
  coalesce(next_name, '') AS next_name, coalesce(next_artist, '') AS next_artist
FROM (VALUES {names}) n(name) LEFT JOIN one ON one.name = n.name AND one.artist = 'Supplier#{LOOKUP_LIST:09d}'""",
        "song_cards": f"""SELECT p.p_name AS name, CASE WHEN l.l_returnflag = 'R' THEN {_COVER} ELSE 'img/' || p.p_brand END AS image,
  s.s_name AS artist FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey""",
        "ingest_lines": "SELECT event_id, event_type, props FROM events",
    }
