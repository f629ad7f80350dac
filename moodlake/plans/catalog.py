"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each running over the whole driver tables.

The mapping from driver tables to the domain lives in ``moodlake.sources``
(plays, library listing, list pages); this module only composes operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.functions import envelope as env
from moodlake.functions import predicates as pred
from moodlake.functions import text as tx
from moodlake.operators import library as lib
from moodlake.operators import lookup, search, trends
from moodlake.operators.lexicon import builtin_lexicon
from moodlake.operators.scoring import score_plays, score_texts
from moodlake.plans import dashboards as dash
from moodlake.plans import browse, streams
from moodlake.plans.harvest import chart_harvest
from moodlake.sources.frames import frames_from_tables
from moodlake.sources.library import library_from_tables
from moodlake.sources.pages import pages_from_tables
from moodlake.sources.tables import FEED_GLOBAL, FEED_ITALY, FEED_PLAYED, plays, sung, table

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the catalogue queries (the operator's own inputs).
ARTIST = "Brand#3"
PLAYLIST = "1-URGENT"
SEARCH_TERM = "12"
CALM_WORDS = [("en", "for"), ("de", "und"), ("fr", "une"), ("es", "para")]


# --- scoring ---------------------------------------------------------------

def _doc_scores(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents"), ["doc_id"], "text", lang="lang")


def compound_score(spark, sf_dir):
    return _doc_scores(spark, sf_dir).select("doc_id", "compound", "sentiment")


def compound_score_negated(spark, sf_dir):
    """A6 with the negation option: negators flip and damp what follows."""
    d = table(spark, sf_dir, "documents")
    return score_texts(d, ["doc_id"], "text", lang="lang", negation=True).select("doc_id", "compound", "sentiment")


def compound_score_rules(spark, sf_dir):
    """A6 with both options: negation and the contrast ('but') rule."""
    d = table(spark, sf_dir, "documents")
    return (score_texts(d, ["doc_id"], "text", lang="lang", negation=True, contrast=True)
            .select("doc_id", "compound", "sentiment"))


def compound_score_intensity(spark, sf_dir):
    """A6 with all rules over sung texts, which hold words of every rule."""
    return (score_texts(sung(spark, sf_dir), ["doc_id"], "lyrics", lang="lang", negation=True, contrast=True,
                        intensity=True).select("doc_id", "compound", "sentiment", "emotion"))


def open_emotion_labels(spark, sf_dir):
    """A7 with a lexicon that holds a label besides the fixed ten."""
    words = ", ".join(f"('{l}', '{w}', 100, 'calm')" for l, w in CALM_WORDS)
    more = spark.sql(f"SELECT * FROM VALUES {words} AS w(lang, word, valence_milli, emotion)")
    return score_texts(sung(spark, sf_dir), ["doc_id"], "lyrics", lang="lang",
                       lexicon=builtin_lexicon(spark).unionByName(more)).select("doc_id", "emotion")


def sentiment_category(spark, sf_dir):
    """T10 per document: category of its compound; the sentinel lyrics
    (the validity gate's output) are 'not applicable' whatever the score."""
    d = table(spark, sf_dir, "documents")
    lyrics = d.select("doc_id", "lang", tx.validate_lyrics("text").alias("lyrics"))
    scored = score_texts(lyrics, ["doc_id"], "lyrics", lang="lang").join(lyrics.select("doc_id", "lyrics"),
                                                                        "doc_id")
    return scored.select("doc_id", tx.sentiment_category("lyrics", "compound").alias("sentiment_category"))


def top_emotion(spark, sf_dir):
    return _doc_scores(spark, sf_dir).select("doc_id", "emotion")


def scored_plays(spark, sf_dir):
    """R1 in batch form: the scored record of every play."""
    p = score_plays(plays(spark, sf_dir))
    iso = tx.iso_timestamp("timestamp")
    return p.select("play_id", tx.combined_id("id", iso).alias("combined_id"), "topic",
                    "sentiment", "emotion",
                    tx.sentiment_category("lyrics", "compound").alias("sentiment_category"),
                    F.md5("cleaned_lyrics").alias("cleaned_md5"))


# --- text functions over documents / pages / parts --------------------------

def clean_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    c = tx.clean_text("text")
    return d.select("doc_id", F.md5(c).alias("cleaned_md5"), F.length(c).alias("cleaned_len"),
                    tx.is_present(c).alias("present"))


def clean_title(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    first = F.substring_index(F.col("text"), "\n", 1)
    return d.select("doc_id", tx.clean_title(first).alias("title"))


def drop_first_line(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(tx.drop_first_line("text")).alias("body_md5"))


def validate_lyrics(spark, sf_dir):
    """F4 + T3: every tenth text carries a footnote mark, every tenth one has its quotes multiplied."""
    d = table(spark, sf_dir, "documents")
    lyrics = (F.when(F.col("doc_id") % 10 == 1, F.concat(F.lit(tx.FOOTNOTE_MARK + "1] "), F.col("text")))
              .when(F.col("doc_id") % 10 == 2, F.replace(F.col("text"), F.lit("e"), F.lit('"'))).otherwise(F.col("text")))
    d = d.select("doc_id", lyrics.alias("text"))
    return d.select("doc_id", tx.count_char("text", '"').alias("quotes"),
                    F.contains(F.col("text"), F.lit(tx.FOOTNOTE_MARK)).alias("footnote"),
                    F.md5(tx.validate_lyrics("text")).alias("lyrics_md5"))


def _page_title(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", "url",
                    F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("raw_title"))


def html_unescape(spark, sf_dir):
    """T6 over whole pages: titles and bodies."""
    p = table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    whole = tx.html_unescape("html")
    return p.select("page_id", tx.html_unescape(title).alias("title"),
                    F.length(whole).alias("length"), F.md5(whole).alias("page_md5"))


def percent_decode(spark, sf_dir):
    t = _page_title(spark, sf_dir)
    return t.select("page_id", tx.percent_decode("url").alias("decoded"),
                    tx.percent_decode(F.concat(F.url_encode("raw_title"), F.lit("+%zz%41"))).alias("decoded_title"))


def after_equals(spark, sf_dir):
    t = _page_title(spark, sf_dir)
    return t.select("page_id", tx.after_equals("url").alias("after_eq"))


def search_keys(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", tx.search_key("p_name", "p_brand", " ").alias("key_spaced"),
                    tx.search_key("p_name", "p_brand", "").alias("key_joined"))


def iso_and_key(spark, sf_dir):
    p = plays(spark, sf_dir)
    iso = tx.iso_timestamp("timestamp")
    return p.select("play_id", iso.alias("iso_timestamp"), tx.combined_id("id", iso).alias("combined_id"))


# --- envelope / feeds ---------------------------------------------------------

def parse_envelope(spark, sf_dir):
    fr = env.decode_frames(frames_from_tables(spark, sf_dir).select("value", "timestamp"))
    parsed = env.parse_envelope(fr)
    return parsed.select("id", "name", "artist", "topic", "genre",
                         F.md5("lyrics").alias("lyrics_md5"),
                         tx.iso_timestamp("timestamp").alias("iso_timestamp"))


def play_envelope(spark, sf_dir):
    p = plays(spark, sf_dir)
    e = env.play_envelope(p, value_only=False)
    return e.select("play_id", F.md5("value").alias("value_md5"))


def unwrap_message(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    wrapped = ev.select("event_id", F.col("props").alias("message"), F.lit(1).alias("@version"),
                        F.lit("player").alias("host"), F.col("event_type").alias("type"),
                        F.lit("INFO").alias("level"))
    schema = T.StructType([T.StructField("k", T.LongType())])
    return env.drop_transport(env.unwrap_message(wrapped, schema))


def union_feeds(spark, sf_dir):
    p = plays(spark, sf_dir).select("play_id", "topic", "doc_id")
    parts = [env.with_feed(pred.by_feed(p, tag).drop("topic"), tag)
             for tag in (FEED_GLOBAL, FEED_ITALY, FEED_PLAYED)]
    return lib.append_pages(*parts).select("play_id", "topic", "doc_id")


def by_feed(spark, sf_dir):
    p = plays(spark, sf_dir)
    return pred.by_feed(p, FEED_ITALY).select("play_id", "name", "artist", "genre")


# --- pages of nested items -----------------------------------------------------

def _flat_items(spark, sf_dir):
    return env.flatten_tracks(env.explode_items(pages_from_tables(spark, sf_dir)))


def flatten_tracks(spark, sf_dir):
    return _flat_items(spark, sf_dir).select("list_id", "position", "id", "name", "artist", "image")


def favourite_neighbors(spark, sf_dir):
    f = _flat_items(spark, sf_dir).select("list_id", "position", "id", "name", "artist")
    n = lib.circular_neighbors(f, ["list_id"], "position", fields=["id"])
    return n.select("list_id", "position", "id", "prev_id", "next_id")


def _artists(spark, sf_dir):
    """Artist records (suppliers): genres = the sorted part types they
    ship; no image when the balance is negative."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    shipped = (li.join(part, li["l_partkey"] == part["p_partkey"])
                 .groupBy("l_suppkey").agg(F.sort_array(F.collect_set("p_type")).alias("genres"),
                                           F.count(F.lit(1)).alias("n")))
    s = table(spark, sf_dir, "supplier")
    j = s.join(shipped, s["s_suppkey"] == shipped["l_suppkey"], "left")
    images = F.when(F.col("s_acctbal") < 0, F.array().cast("array<struct<url:string>>")) \
        .otherwise(F.array(F.struct(F.concat(F.lit("img/"), F.col("s_name")).alias("url"))))
    return j.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"),
                    images.alias("images"),
                    F.struct(F.coalesce(F.col("n"), F.lit(0)).alias("total")).alias("followers"),
                    F.col("s_nationkey").cast("long").alias("popularity"),
                    F.coalesce(F.col("genres"), F.array().cast("array<string>")).alias("genres"),
                    F.col("s_suppkey").alias("rank"), "s_acctbal")


def artist_profile(spark, sf_dir):
    a = _artists(spark, sf_dir).withColumn("primary_genre", env.primary_genre(F.struct("genres")))
    return env.artist_profile(a, "primary_genre")


def artist_cards(spark, sf_dir):
    return env.cards(_artists(spark, sf_dir), "artist")


def with_genre(spark, sf_dir):
    # Every fifth list names artists that the dimension does not have; every
    # seventh artist ships nothing it has a genre for.
    miss = F.when(F.col("list_id") % 5 == 0, F.lit(" (unknown)")).otherwise(F.lit(""))
    tracks = _flat_items(spark, sf_dir).select("list_id", "position", F.concat("artist", miss).alias("artist"))
    none = F.array().cast("array<string>")
    found = _artists(spark, sf_dir).withColumn(
        "genres", F.when(F.col("id").cast("long") % 7 == 0, none).otherwise(F.col("genres")))
    return lookup.with_genre(tracks, found)


# --- library ----------------------------------------------------------------------

def _library(spark, sf_dir, form="split"):
    return lib.with_names(library_from_tables(spark, sf_dir), form=form)


def parse_file_split(spark, sf_dir):
    return _library(spark, sf_dir).select("path", "name", "artist")


def parse_file_index(spark, sf_dir):
    l_ = _library(spark, sf_dir, form="index")
    return l_.select("path", "name", "artist",
                     tx.library_path("kind", "container", "name", "artist").alias("rebuilt"))


def by_artist(spark, sf_dir):
    return pred.by_artist(_library(spark, sf_dir), ARTIST).select("path", "kind", "container", "name")


def by_container(spark, sf_dir):
    return pred.by_container(_library(spark, sf_dir), "playlists", PLAYLIST).select("path", "name", "artist")


def distinct_artists(spark, sf_dir):
    return lib.distinct_artists(_library(spark, sf_dir))


def artist_library(spark, sf_dir):
    out = lib.artist_library(_library(spark, sf_dir), ARTIST)
    return out.select("path", "kind", "container", "name", "kind_rank")


def delete_song(spark, sf_dir):
    return lib.delete_song(_library(spark, sf_dir), "red widget", "Brand#17").select("path")


def delete_container(spark, sf_dir):
    return lib.delete_container(_library(spark, sf_dir), "playlists", PLAYLIST).select("path")


def delete_from(spark, sf_dir):
    l_ = _library(spark, sf_dir)
    doomed = l_.filter((F.col("kind") == "songs") & (F.col("artist") == ARTIST))
    return lib.containers(lib.delete_from(l_, "playlists", "2-HIGH", doomed))


def delete_everywhere(spark, sf_dir):
    l_ = _library(spark, sf_dir)
    doomed = l_.filter((F.col("kind") == "songs") & (F.col("artist") == ARTIST))
    return lib.delete_everywhere(l_, doomed).select("path")


def library_delete(spark, sf_dir):
    l_ = _library(spark, sf_dir)
    doomed = pred.by_container(l_, "playlists", "3-MEDIUM")
    return lib.library_delete(l_, doomed, ["name", "artist"]).select("path")


def library_neighbors(spark, sf_dir):
    """W1 over sparse positions: the files of every folder (the songs' one too) in file-name order."""
    n = lib.circular_neighbors(_library(spark, sf_dir).select("kind", "container", "file_name"), ["kind", "container"],
                               "file_name", fields=["file_name"])
    return n.select("kind", "container", "file_name", "prev_file_name", "next_file_name")


# --- duplicates over line items ------------------------------------------------------

_LI_KEYS = ["l_orderkey", "l_linenumber"]


def duplicate_members(spark, sf_dir):
    return lib.duplicate_members(table(spark, sf_dir, "lineitem"), _LI_KEYS)


def dedupe_keep_first(spark, sf_dir):
    return lib.dedupe_keep_first(table(spark, sf_dir, "lineitem"), _LI_KEYS, ["l_shipdate"])


def purge_duplicates(spark, sf_dir):
    """M5: line items as favourites; a track's id is its order, line, part and supplier."""
    li = table(spark, sf_dir, "lineitem").withColumn("id", F.concat_ws("-", *_LI_KEYS, "l_partkey", "l_suppkey"))
    return lib.purge_duplicates(li, _LI_KEYS).drop("id")


# --- ordered lists ---------------------------------------------------------------------

def circular_neighbors(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    n = lib.circular_neighbors(c, ["conv_id"], "turn", fields=["turn", "role"])
    return n.select("conv_id", "turn", "role", "prev_turn", "prev_role", "next_turn", "next_role")


def number_items(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    n = lib.number_items(o, ["o_orderdate", "o_orderkey"], partition=["o_orderpriority"])
    return n.select("o_orderkey", "o_orderpriority", "item_number")


def page(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return search.page(o, ["o_orderdate", "o_orderkey"], offset=100, limit=50)


# --- lookups and search ---------------------------------------------------------------

def with_lyrics(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    tracks = d.select("doc_id", F.concat(F.lit("song "), F.col("doc_id").cast("string"),
                                         F.when(F.col("lang") == "de", F.lit(" [Remastered]"))
                                          .when(F.col("lang") == "fr", F.lit(" (live)"))
                                          .when(F.col("doc_id") % 7 == 0, F.lit(" unknown"))
                                          .otherwise(F.lit(""))).alias("name"),
                      F.col("source").alias("artist"))
    dim = d.select(
        F.concat(F.lit("song "), F.col("doc_id").cast("string")).alias("title"),
        F.col("source").alias("artist"), F.col("doc_id").alias("rank"), F.col("text").alias("lyrics"))
    out = lookup.with_lyrics(tracks, dim)
    return out.select("doc_id", "name", F.md5("lyrics").alias("lyrics_md5"),
                      (F.col("lyrics") == tx.SENTINEL_LYRICS).alias("not_found"))


def with_track_id(spark, sf_dir):
    songs = _library(spark, sf_dir).filter(F.col("kind") == "songs").select("path", "name", "artist")
    cat = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                                              F.col("p_brand").alias("artist"), F.col("p_partkey").alias("rank"))
    return lookup.with_track_id(songs, cat)


def _catalogs(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return {"artist": s, "album": n, "song": p, "playlist": c}


def search_all(spark, sf_dir):
    return search.search(_catalogs(spark, sf_dir), SEARCH_TERM)


def search_playlist(spark, sf_dir):
    return search.search({"playlist": _catalogs(spark, sf_dir)["playlist"]}, "Customer#0000001",
                         {"playlist": 1})


def artist_top_tracks(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    pl = (li.join(s, li["l_suppkey"] == s["s_suppkey"]).join(n, s["s_nationkey"] == n["n_nationkey"])
            .join(p, li["l_partkey"] == p["p_partkey"])
            .select(F.col("s_name").alias("artist"), F.col("l_partkey").alias("track_id"),
                    F.col("p_name").alias("name"),
                    F.array_compact(F.array("n_name", F.when(F.col("n_nationkey") % 3 == 0, search.MARKET))).alias("markets")))
    return search.artist_top_tracks(pl, n=3)


def track_neighbors(spark, sf_dir):
    """F1 + W1 + W3: neighbours of the first list entry of one track."""
    f = _flat_items(spark, sf_dir).select("list_id", "position", "id", "name", "artist")
    n = lib.circular_neighbors(f, ["list_id"], "position", fields=["id"])
    hit = n.filter(pred.match_track("red widget", "Supplier#000000007"))
    return hit.orderBy("list_id", "position").limit(1).select("list_id", "position", "id", "prev_id", "next_id")


def album_cards(spark, sf_dir):
    """P10: album cards (orders as albums, the customer as first artist;
    finished orders have no cover)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    images = F.when(F.col("o_orderstatus") == "F", F.array().cast("array<struct<url:string>>")) \
        .otherwise(F.array(F.struct(F.concat(F.lit("img/album-"), F.col("o_orderkey").cast("string")).alias("url"))))
    albums = o.join(c, o["o_custkey"] == c["c_custkey"], "left").select(
        F.concat(F.lit("album-"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderkey").cast("string").alias("id"), images.alias("images"),
        F.array(F.struct(F.col("c_name").alias("name"))).alias("artists"))
    return env.cards(albums, "album")


def artist_albums(spark, sf_dir):
    """L5 (albums): the 50 newest album cards of each artist (the nation of the order's customer)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    images = F.when(F.col("o_orderstatus") == "F", F.array().cast("array<struct<url:string>>")) \
        .otherwise(F.array(F.struct(F.concat(F.lit("img/album-"), F.col("o_orderkey").cast("string")).alias("url"))))
    albums = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"]).select(
        F.concat(F.lit("album-"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderkey").cast("string").alias("id"), images.alias("images"),
        F.array(F.struct(F.col("n_name").alias("name"))).alias("artists"),
        F.to_date("o_orderdate").alias("released"))
    cards = env.cards(albums, "album", "released")
    return search.artist_albums(cards).select("artist", "id", "name", "image", "released", "rank")


def playlist_cards(spark, sf_dir):
    """P10: playlist cards (customers as playlists)."""
    c = table(spark, sf_dir, "customer")
    images = F.when(F.col("c_acctbal") < 0, F.array().cast("array<struct<url:string>>")) \
        .otherwise(F.array(F.struct(F.concat(F.lit("img/"), F.col("c_name")).alias("url"))))
    return env.cards(c.select(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("id"),
                              images.alias("images")), "playlist")


def to_frames(spark, sf_dir):
    """K2: each event as one JSON value."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    fr = env.to_frames(ev)
    return fr.select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"),
                     F.md5("value").alias("value_md5"))


def sql_functions(spark, sf_dir):
    """The registered SQL functions used from SQL text."""
    from moodlake.functions.sql import register_sql
    register_sql(spark)
    table(spark, sf_dir, "documents").createOrReplaceTempView("ml_documents")
    return spark.sql("""
        SELECT doc_id, md5(clean_text(text)) AS cleaned_md5,
               clean_title(substring_index(text, '\n', 1)) AS title,
               md5(validate_lyrics(text)) AS lyrics_md5, count_char(text, '"') AS quotes,
               md5(drop_first_line(text)) AS body_md5, md5(html_unescape(text)) AS unescaped_md5,
               percent_decode(concat(source, '%C3%A9+%zz')) AS decoded,
               after_equals(concat('v=', lang, '=', source)) AS after_eq,
               search_key(lang, source, '-') AS key,
               sentiment_category(IF(doc_id % 5 = 0, 'Lyrics not found', text), CAST(doc_id % 9 - 4 AS DOUBLE) / 4) AS category,
               combined_id(CAST(doc_id AS STRING), iso_timestamp(timestamp_seconds(doc_id))) AS combined,
               score_text(CAST(doc_id % 9 - 4 AS DOUBLE) / 4) AS score,
               library_path('albums', lang, source, CAST(doc_id AS STRING)) AS path,
               s.name AS split_name, s.artist AS split_artist, i.name AS index_name, i.artist AS index_artist
        FROM ml_documents,
             LATERAL parse_file_split(concat(lang, ' - ', source, ' - ', doc_id, '.mp3')) AS s,
             LATERAL parse_file_index(concat(lang, ' - ', source, ' - ', doc_id, '.mp3')) AS i""")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "mood_board": dash.mood_board,
        "mood_counts": dash.mood_counts,
        "category_counts": dash.category_counts,
        "genre_counts": dash.genre_counts,
        "artist_counts": dash.artist_counts,
        "top_artists": dash.top_artists,
        "compound_score": compound_score,
        "top_emotion": top_emotion,
        "compound_score_negated": compound_score_negated,
        "compound_score_rules": compound_score_rules,
        "compound_score_intensity": compound_score_intensity,
        "open_emotion_labels": open_emotion_labels,
    }
    q["genre_trend_week"] = lambda s, d: dash.genre_trend(s, d, "week")
    q["artist_trend_month"] = lambda s, d: dash.attribute_trend(s, d, "month", "artist", spread=True)
    q["top_emotions"] = lambda s, d: trends.top_n(dash.mood_counts(s, d), "emotion", 3, partition="topic")
    q["sentiment_category"] = sentiment_category
    for g in ("day", "week", "month"):
        q[f"taste_trend_{g}"] = (lambda grain: lambda s, d: dash.taste_trend(s, d, grain, spread=grain == "month"))(g)
    for fn in (scored_plays, clean_text, clean_title, drop_first_line, validate_lyrics,
               html_unescape, percent_decode, after_equals, search_keys, iso_and_key,
               parse_envelope, play_envelope, unwrap_message, union_feeds, by_feed,
               flatten_tracks, favourite_neighbors, artist_profile, artist_cards, with_genre,
               parse_file_split, parse_file_index, by_artist, by_container, distinct_artists,
               artist_library, delete_song, delete_container, delete_from, delete_everywhere,
               library_delete, library_neighbors, duplicate_members, dedupe_keep_first,
               purge_duplicates, circular_neighbors, number_items, page, with_lyrics,
               with_track_id, search_all, search_playlist, artist_top_tracks,
               track_neighbors, album_cards, artist_albums, playlist_cards, to_frames, sql_functions):
        q[fn.__name__] = fn
    q.update(browse.queries())
    q["chart_harvest"] = chart_harvest
    q["stream_scoring"] = streams.stream_scoring
    q["stream_replay"] = streams.stream_replay
    q["stream_restart"] = streams.stream_restart
    for g in ("day", "week", "month"):
        q[f"stream_trend_{g}"] = (lambda grain: lambda s, d: streams.stream_trend_rows(s, d, grain))(g)
    return q
