"""Disguises at the edges, with few letters, and of any length."""

import time

import pytest

from moodlake.llm import toxicity

from tests.llm.test_others import letters


@pytest.mark.parametrize("written, meant", [
    ("$tupid", "stupid"), ("|diot", "idiot"), ("+he", "the"), ("m0r0n!!", "moron"),
    ("$+upid", "stupid"), ("$7up1d", "stupid"), ("1d10+", "idiot"), ("50up", "soup"), ("|0$3r", "loser"),
    ("(soup)", "soup"), ("soup+", "soup"), ("table|", "table"),
    ("$20", ""), ("(2024)", ""), ("+1", ""), ("| 1 | 2 | 3 |", ""), ("***", ""),
    ("i" + "d" + "i" + "o" * 40 + "t", "idiot"), ("-".join("idiotmoronclownstupid"), "idiotmoronclownstupid"),
    (" ".join("idiotmoronclownstupidloser"), "idiotmoronclownstupidloser")])
def test_disguises(written, meant):
    assert toxicity.restored_text(written, letters()).replace(" ", "") == meant


def test_no_length_is_left_out():
    m = letters()
    whole = "the_m0r0n_was_" * 2000
    assert toxicity.disguised(whole)
    begin = time.time()
    got = toxicity.decode(whole, m)
    assert got == "themoronwas" * 2000 and time.time() - begin < 20


def test_putting_aside_changes_no_path(monkeypatch):
    m = letters()
    words = ["m0r0n", "cl00wwwn-1d10t-s+up!d-l0ser" * 3, " ".join("idiotmoronclown" * 5)]
    want = [toxicity.decode(w, m) for w in words]
    for n in (1, 3, 10**9):
        monkeypatch.setattr(toxicity, "SETTLE", n)
        assert [toxicity.decode(w, m) for w in words] == want


def test_the_fit_gets_one_row_per_sampled_id(spark, monkeypatch):
    rows = [(1, f"some text number {i}") for i in range(300)] + [(i, f"the idiot {i}") for i in range(2, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i > 1)) for i in range(1, 12)] + [(20, 0)], "doc_id long, toxic int")
    seen = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda active, y, n: seen.append(len(y)) or fit(active, y, n))
    model = toxicity.learn(docs, labels, toxicity.F.lit(True))
    assert seen == [11] and toxicity.score(docs, model).count() == len(rows)
