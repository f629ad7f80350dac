"""Envelope parsing and nested access."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.functions import envelope as env


def frames(spark, values):
    rows = [(None if v is None else v.encode(), None) for v in values]
    return spark.createDataFrame(rows, "value BINARY, timestamp TIMESTAMP")


def test_parse_envelope_edges(spark):
    vals = [
        json.dumps({"topic": "song_played", "name": "N", "artist": "A", "lyrics": "L", "genre": None, "id": "x1"}),
        json.dumps({"topic": "t", "name": "N"}),                       # missing fields
        json.dumps({"id": 123, "name": {"a": 1}, "topic": "t"}),       # number and object
        "{not json",                                                   # malformed
    ]
    out = env.parse_envelope(env.decode_frames(frames(spark, vals))).collect()
    assert out[0].genre is None and out[0].id == "x1"
    assert out[1].artist is None and out[1].lyrics is None and out[1].name == "N"
    assert out[2].id == "123" and json.loads(out[2].name) == {"a": 1}
    assert all(getattr(out[3], f) is None for f in ["id", "name", "lyrics", "artist", "topic", "genre"])
    assert len(out) == 4


def test_play_envelope_round_trip(spark):
    df = spark.createDataFrame([("song_played", "N", "A", "L", None, "7")],
                               "topic STRING, name STRING, artist STRING, lyrics STRING, genre STRING, id STRING")
    v = env.play_envelope(df, feed="song_global_top").first().value
    rec = json.loads(v)
    assert rec["topic"] == "song_global_top" and rec["id"] == "7" and list(rec)[0] == "topic"
    back = env.parse_envelope(env.play_envelope(df)).first()
    assert back.name == "N" and back.genre is None


def test_unwrap_and_drop_transport(spark):
    df = spark.createDataFrame([('{"name": "N", "host": "inner"}', "h", "p", "x")],
                               "message STRING, host STRING, path STRING, keep STRING")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("host", T.StringType())])
    u = env.unwrap_message(df, schema)
    assert set(u.columns) == {"path", "keep", "name", "host"} and u.first().host == "inner"
    assert env.drop_transport(u).columns == ["keep", "name"]


def test_nested_tracks_and_defaults(spark):
    schema = env.PAGE_SCHEMA
    page = {"items": [
        {"track": {"id": "1", "name": "S1", "artists": [{"name": "A1"}, {"name": "A2"}],
                   "album": {"images": [{"url": "u1"}, {"url": "u2"}]}}},
        {"track": {"id": "2", "name": "S2", "artists": [], "album": {"images": []}}},
    ]}
    df = spark.createDataFrame([(page["items"],)], T.StructType([schema["items"]]))
    df = df.withColumn("offset", F.lit(50).cast("long"))
    flat = env.flatten_tracks(env.explode_items(df)).orderBy("position").collect()
    assert [(r.position, r.artist, r.image) for r in flat] == [(50, "A1", "u1"), (51, None, env.DEFAULT_IMAGE)]


def test_genres_and_profile(spark):
    rows = [("1", "A", [], {"total": 5}, 10, ["pop", "rock"]),
            ("2", "B", [{"url": "i"}], {"total": 0}, 1, []),
            ("3", "C", [], {"total": 0}, 1, ["", "x"])]
    df = spark.createDataFrame(rows, env.ARTIST_SCHEMA)
    prof = {r.id: r for r in env.artist_profile(df).collect()}
    assert prof["1"].genres == "pop, rock" and prof["1"].image is None and prof["2"].genres == ""
    pg = {r.id: r.g for r in df.select("id", env.primary_genre(F.struct("genres")).alias("g")).collect()}
    assert pg == {"1": "pop", "2": "not applicable", "3": "not applicable"}
    missing = spark.createDataFrame([(None,)], "a STRUCT<genres: ARRAY<STRING>>")
    assert missing.select(env.primary_genre("a")).first()[0] is None
    cards = env.cards(df, "artist").orderBy("id").collect()
    assert cards[0].image == env.DEFAULT_IMAGE and cards[1].image == "i"
