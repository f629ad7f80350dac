"""Library operators: neighbours, duplicates, deletes, ranks (J4, J5, W1-W4, M*, A5)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from moodlake.operators import library as lib
from moodlake.operators.ranking import first_per_key, sequence_number


def test_circular_neighbors_edges(spark):
    rows = [("L1", 0, "a"), ("L1", 1, "b"), ("L1", 2, "c"), ("L2", 0, "solo")]
    df = spark.createDataFrame(rows, "list STRING, pos INT, name STRING")
    n = {(r.list, r.pos): (r.prev_name, r.next_name)
         for r in lib.circular_neighbors(df, ["list"], "pos", fields=["name"]).collect()}
    assert n[("L1", 0)] == ("c", "b")          # first: prev wraps to last
    assert n[("L1", 2)] == ("b", "a")          # last: next wraps to first
    assert n[("L2", 0)] == ("solo", "solo")    # single item points at itself


def test_circular_neighbors_sparse_positions(spark):
    rows = [("L", 10, "a"), ("L", 20, "b"), ("L", 35, "c"), ("M", 5, "x"), ("M", 7, "y")]
    df = spark.createDataFrame(rows, "list STRING, pos INT, name STRING")
    n = {r.name: (r.prev_name, r.next_name)
         for r in lib.circular_neighbors(df, ["list"], "pos", fields=["name"]).collect()}
    assert n == {"a": ("c", "b"), "b": ("a", "c"), "c": ("b", "a"), "x": ("y", "y"), "y": ("x", "x")}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=30, unique=True))
def test_prev_of_next_is_identity(spark, positions):
    df = spark.createDataFrame([("L", p, f"t{p}") for p in positions], "list STRING, pos INT, name STRING")
    n = {r.name: (r.prev_name, r.next_name)
         for r in lib.circular_neighbors(df, ["list"], "pos", fields=["name"]).collect()}
    for name, (_, nxt) in n.items():
        assert n[nxt][0] == name


def test_sequence_number_equals_window_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 5003).alias("o"))
    got = sequence_number(df, ["g"], ["o"], out="rn", num_partitions=7)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_sequence_number_over_a_join(spark):
    # A join's output order changes between evaluations; numbering must not.
    left = spark.range(0, 4000).select((F.col("id") % 5).alias("g"), F.col("id").alias("o"))
    right = spark.range(0, 4000).select(F.col("id").alias("o"), (F.col("id") * 3).alias("v"))
    df = left.join(right, "o")
    got = sequence_number(df, ["g"], ["o"], num_partitions=6)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert sorted(got.select("g", "o", "v", "rn").collect()) == sorted(want.select("g", "o", "v", "rn").collect())


def test_sequence_number_with_one_hot_key(spark):
    # One key holds almost every row; it spans several range partitions.
    df = spark.range(0, 3000).select(F.when(F.col("id") < 2900, 0).otherwise(F.col("id")).alias("g"),
                                     F.col("id").alias("o"))
    got = sequence_number(df, ["g"], ["o"], num_partitions=8).filter("g = 0")
    assert got.agg(F.min("rn"), F.max("rn"), F.count("*")).first() == (1, 2900, 2900)


def test_duplicate_members_parity(spark):
    rows = [("1", "S", "A", 0), ("2", "S", "A", 1),   # different records, same key → both
            ("3", "T", "B", 2), ("3", "T", "B", 2),   # byte-identical copies → neither
            ("4", "U", "C", 3)]
    df = spark.createDataFrame(rows, "id STRING, name STRING, artist STRING, position INT")
    dup = sorted(r.id for r in lib.duplicate_members(df).collect())
    assert dup == ["1", "2"]
    assert sorted(r.id for r in lib.purge_duplicates(df).collect()) == ["3", "3", "4"]
    first = {r.name: r.id for r in lib.dedupe_keep_first(df).collect()}
    assert first == {"S": "1", "T": "3", "U": "4"}


def test_first_per_key_breaks_ties_deterministically(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", 2, "0")], "k STRING, o INT, v STRING")
    assert first_per_key(df, ["k"], ["o"]).first().v == "a"


def lib_rows(spark):
    rows = [("songs", None, "S1 - A.mp3", "S1", "A"), ("albums", "X", "S1 - A.mp3", "S1", "A"),
            ("albums", "X", "S2 - B.mp3", "S2", "B"), ("playlists", "P", "S1 - A.mp3", "S1", "A"),
            ("playlists", "Q", "S3 - C.mp3", "S3", "C")]
    df = spark.createDataFrame(rows, "kind STRING, container STRING, file_name STRING, name STRING, artist STRING")
    return df.withColumn("path", F.concat_ws("/", "kind", "container", "file_name"))


def test_deletes(spark):
    df = lib_rows(spark)
    doomed = spark.createDataFrame([("S1", "A")], "name STRING, artist STRING")
    assert lib.delete_song(df, "S1", "A").count() == 4
    assert lib.delete_container(df, "albums", "X").count() == 3
    after = lib.delete_from(df, "playlists", "P", doomed)
    assert after.count() == 4
    assert {(r.kind, r.container) for r in lib.containers(after).collect()} == {("albums", "X"), ("playlists", "Q")}
    assert sorted(r.name for r in lib.delete_everywhere(df, doomed).collect()) == ["S2", "S3"]


def test_distinct_artists_and_artist_library(spark):
    df = lib_rows(spark)
    a = {r.artist: (r.first_kind_rank, r.first_container) for r in lib.distinct_artists(df).collect()}
    assert a == {"A": (0, "X"), "B": (0, "X"), "C": (1, "Q")}
    v = lib.artist_library(df, "A", ["songs", "albums", "playlists"]).orderBy("kind_rank").collect()
    assert [r.kind for r in v] == ["songs", "albums", "playlists"]


def test_number_items(spark):
    df = spark.createDataFrame([("f", 3), ("f", 1), ("g", 2), ("f", 2)], "topic STRING, position INT")
    got = sorted((r.topic, r.position, r.item_number) for r in lib.number_items(df, ["position"]).collect())
    assert got == [("f", 1, 1), ("f", 2, 2), ("f", 3, 3), ("g", 2, 1)]


def test_neighbors_of_first_match_and_miss(spark):
    rows = [(0, "a", "x", "i0"), (1, "b", "y", "i1"), (2, "a", "x", "i2"), (7, "c", "z", "i3")]
    df = spark.createDataFrame(rows, "position INT, name STRING, artist STRING, image STRING").repartition(3)
    hit = lib.neighbors_of(df, "a", "x").collect()
    assert [tuple(r) for r in hit] == [("a", "x", "i0", "c", "z", "b", "y")]
    assert tuple(lib.neighbors_of(df, "c", "z").first()) == ("c", "z", "i3", "a", "x", "a", "x")
    one = df.filter("position = 1")
    assert tuple(lib.neighbors_of(one, "b", "y").first()) == ("b", "y", "i1", "b", "y", "b", "y")
    for empty in (df, df.filter("false")):
        assert tuple(lib.neighbors_of(empty, "nope", "x").first()) == ("nope", "x", "static/default-cover.jpg", "", "", "", "")
    plan = lib.neighbors_of(df, "a", "x")._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "Window" not in plan and "Exchange range" not in plan


def test_duplicate_keys_tell_nulls_apart(spark):
    rows = [("k", 1, None, 2), ("k", 1, 2, None), ("same", 1, None, 2), ("same", 1, None, 2), ("one", 1, 1, 1)]
    df = spark.createDataFrame(rows, "key STRING, a INT, b INT, c INT")
    keys = lib.duplicate_keys(df, ["key"])
    assert [r.key for r in keys.collect()] == ["k"]
    assert "Sort" not in keys._jdf.queryExecution().executedPlan().toString()


def test_row_numbers_equal_the_window(spark):
    from pyspark.sql import Window
    from moodlake.operators.ranking import row_numbers
    df = spark.range(3000).select((F.col("id") % 4).alias("g"), (F.col("id") * 7919 % 3000).alias("o"))
    want = df.withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    got = row_numbers(df, ["g"], ["o"]).join(want, ["g", "o"])
    assert got.count() == 3000 and got.where("rn <> w").count() == 0


def test_neighbors_with_gaps_and_repeated_positions(spark):
    df = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y"), ("a", 3, "z"), ("b", 2, "p"), (None, 1, "q"), (None, 1, "r")],
                               "list string, pos int, name string")
    got = {(r.list, r.name): (r.prev_name, r.next_name) for r in lib.circular_neighbors(df, ["list"], "pos", fields=["name"]).collect()}
    assert got == {("a", "x"): ("z", "y"), ("a", "y"): ("x", "z"), ("a", "z"): ("y", "x"), ("b", "p"): ("p", "p"),
                   (None, "q"): ("r", "r"), (None, "r"): ("q", "q")}


def test_circular_neighbors_null_container_is_a_list(spark):
    rows = [(None, 0, "a"), (None, 1, "b"), ("L", 0, "x")]
    df = spark.createDataFrame(rows, "list STRING, pos INT, name STRING")
    n = {r.name: (r.prev_name, r.next_name)
         for r in lib.circular_neighbors(df, ["list"], "pos", fields=["name"]).collect()}
    assert n == {"a": ("b", "b"), "b": ("a", "a"), "x": ("x", "x")}
