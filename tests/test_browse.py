"""Search index, page index, assembled lists, late text lookup and the branches of the fixtures."""

import os
import random

from pyspark.sql import functions as F

from moodlake.operators import paging
from moodlake.operators.lookup import with_lyrics
from moodlake.operators.search import search
from moodlake.operators.search_index import build_index, read_postings, search_index
from moodlake.sources.pages import assemble_lists, read_item_pages, write_item_pages

from tests.conftest import SF_SMALL


def names(n, seed=1):
    r = random.Random(seed)
    return [(i, "".join(r.choice("abAB ") for _ in range(r.randint(1, 6))), f"img{i}" if i % 2 else None) for i in range(n)]


def test_index_equals_the_scan_for_every_kind_of_term(spark, tmp):
    cats = {k: spark.createDataFrame(names(60, i), "id int, name string, image string") for i, k in
            enumerate(("artist", "album", "song", "playlist"))}
    path = build_index(cats, os.path.join(tmp, "index"), buckets=4)
    for term in ("a", "Ab", "aba", "abab", "a b", " ", "b a b", "zz", "'"):
        want = sorted((r.kind, r["rank"], r.id, r.name, r.relevance) for r in search(cats, term).collect())
        rows = search_index(spark, path, term, buckets=4).collect()
        assert sorted((r.kind, r["rank"], r.id, r.name, r.relevance) for r in rows) == want, term
        assert all(r.image == (f"img{r.id}" if int(r.id) % 2 else None) and r.artist is None for r in rows)
    assert search_index(spark, path, "", buckets=4).collect() == []
    from moodlake.operators.search_index import candidates
    plan = candidates(spark, path, "abab", ["song"], 4)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    assert read_postings(spark, path).select("bucket").distinct().count() == 4


def test_deep_page_reads_its_rows_only(spark, tmp):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("k"), F.col("id").alias("v"))
    path = paging.build_page_index(df, ["k"], os.path.join(tmp, "pages"), partitions=8)
    for offset in (0, 49, 4_999, 12_340, 19_990, 25_000):
        got = [(r.position, r.k) for r in paging.read_page(spark, path, offset).orderBy("position").collect()]
        assert got == [(i, i) for i in range(offset, min(offset + 50, 20_000))]
    page = paging.read_page(spark, path, 12_340)
    assert "PartitionFilters" in page._jdf.queryExecution().executedPlan().toString()
    assert page.select(F.input_file_name()).distinct().count() <= 2
    assert paging.read_pages(spark, path).agg(F.count("*"), F.max("page")).first()[:] == (1000, 19)
    short = paging.build_page_index(df.where("k < 120"), ["k"], os.path.join(tmp, "short"), partitions=3)
    assert paging.read_pages(spark, short).count() == 120


def test_lists_end_at_the_first_empty_or_missing_page(spark, tmp):
    rows = [("a", 0, [1, 2]), ("a", 2, [3, 4]), ("a", 4, [5]), ("gap", 0, [1, 2]), ("gap", 4, [9]), ("empty", 0, [1, 2]),
            ("empty", 2, []), ("empty", 4, [9]), ("none", 2, [9]), (None, 0, [7])]
    pages = spark.createDataFrame(rows, "list string, offset long, items array<int>")
    got = assemble_lists(pages.where("list is not null"), ["list"], page_size=2)
    items = sorted((r.list, r.i) for r in got.select("list", F.explode("items").alias("i")).collect())
    assert items == [("a", i) for i in range(1, 6)] + [("empty", 1), ("empty", 2), ("gap", 1), ("gap", 2)]
    write_item_pages(pages, os.path.join(tmp, "p"))
    assert read_item_pages(spark, os.path.join(tmp, "p"), pages.schema).count() == len(rows)


def test_lyrics_are_fetched_for_winners_only(spark):
    dim = spark.createDataFrame([("t", "a", 2, "x\nlate"), ("t", "a", 1, "x\nfirst"), ("t", "a", 1, "x\nfirst"), ("u", "a", 1, "[FN#"),
                                 ("v", None, 1, "y\nnull artist"), ("w", "a", 1, None)],
                                "title string, artist string, rank int, lyrics string")
    tracks = spark.createDataFrame([(1, "t (live)", "a"), (2, "t", "a"), (3, "u", "a"), (4, "v", None), (5, "w", "a"), (6, "z", "a")],
                                   "id int, name string, artist string")
    out = with_lyrics(tracks, dim)
    none = "Lyrics not found"
    assert {r.id: r.lyrics for r in out.collect()} == {1: "first", 2: "first", 3: none, 4: "null artist", 5: none, 6: none}
    for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines():
        if "Aggregate" in line:
            assert "_l#" not in line


def test_both_sides_of_every_branch_occur(spark):
    """The fixtures of the queries reach the branches they stand for."""
    import __spark_entry__ as E
    q = E.queries()
    gate = q["validate_lyrics"](spark, SF_SMALL)
    assert gate.where("footnote").count() and gate.where("quotes >= 50").count() and gate.where("not footnote and quotes < 50").count()
    assert q["taste_trend_month"](spark, SF_SMALL).select("period").distinct().count() > 1
    assert q["artist_trend_month"](spark, SF_SMALL).select("period").distinct().count() > 1
    paged = q["paged_neighbors"](spark, SF_SMALL).groupBy("list_id").count()
    assert paged.where("count > 50").count()
    assert q["artist_albums"](spark, SF_SMALL).agg(F.max("rank")).first()[0] == 50
    cards = q["search_cards"](spark, SF_SMALL)
    assert {r.kind: r.n for r in cards.where("term = 'u'").groupBy("kind").agg(F.max("rank").alias("n")).collect()} == \
        {"artist": 10, "album": 12, "song": 10, "playlist": 12} and cards.where("image like 'static%'").count()
    labels = {r.emotion for r in q["open_emotion_labels"](spark, SF_SMALL).select("emotion").distinct().collect()}
    assert "calm" in labels and len(labels) > 3
    rules = {r.doc_id: r.compound for r in q["compound_score_intensity"](spark, SF_SMALL).collect()}
    from moodlake.operators.scoring import score_texts
    from moodlake.sources.tables import sung
    for off in ("negation", "contrast", "intensity"):
        on = {k: k != off for k in ("negation", "contrast", "intensity")}
        other = {r.doc_id: r.compound for r in score_texts(sung(spark, SF_SMALL), ["doc_id"], "lyrics", **on).collect()}
        assert any(rules[d] != other[d] for d in rules), off


def test_postings_shuffle_names_and_not_their_grams(spark):
    from moodlake.operators.search_index import postings
    cards = spark.createDataFrame([("song", "1", "Blue"), ("song", "1", "Blue"), ("album", "1", "b")], "kind string, id string, name string")
    rows = postings(cards, 3, 4)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange")      # every shuffle lies below the explode
    got = [(r.kind, r.gram) for r in rows.collect()]
    assert len(got) == len(set(got)) == 10                      # a card that is there twice is posted once
