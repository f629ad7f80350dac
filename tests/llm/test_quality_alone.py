"""Every dimension can reject a text by itself, in groups whose other texts have none of it."""

import random

import numpy as np

from moodlake.llm import quality as Q


def test_law():
    r = np.random.default_rng(5)
    d2 = r.chisquare(Q.D, 400_000) / (r.chisquare(Q.FREEDOM, 400_000) / Q.FREEDOM)
    assert abs(np.median(d2) / Q.LAW_MEDIAN - 1) < 0.02 and abs((d2 > Q.CUT).mean() - 0.001) < 0.0003


def test_digits_or_repetition_alone_reject(spark):
    r = random.Random(8)
    plain = [" ".join("".join(r.choice("abcdefghijklmnopqrst") for _ in range(r.randint(3, 8))) + r.choice(["", "", "", ",", "."])
                      for _ in range(120)).capitalize() for _ in range(400)]

    def with_digits(t, words):
        """The same text with the letters of its first words as digits, marks and capitals elsewhere as they are."""
        parts = t.split(" ")
        return " ".join(["".join(str(r.randrange(10)) if c.isalpha() and c.islower() else c for c in w) for w in parts[:words]] + parts[words:])

    half = with_digits(plain[0], 60)
    words = plain[1].split(" ")
    repeated = " ".join(words[:102] + words[:18])     # 36 of 120 words, the most that the base rules let pass
    rows = [(i, t, "en", "s") for i, t in enumerate(plain)] + [(1000, half, "en", "s"), (1001, with_digits(plain[2], 120), "en", "s"),
                                                                (1002, repeated, "en", "s")]
    got = {x.doc_id: x for x in Q.quality_report(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    for i in (1000, 1001, 1002):
        assert not got[i].base_failed and not got[i].kept, (i, got[i].distance, Q.CUT)
    assert sum(not got[i].kept for i in range(400)) <= 2


def test_largest_values_alone_pass_the_cut():
    """By the transforms of the code, at the median distance that a group of floors alone has."""
    biggest = {"repetition": np.log2(31), "digits": np.log2(201)}
    for name, value in biggest.items():
        floor = Q.FLOOR[Q.DIMS.index(name)]
        assert (value / floor) ** 2 * Q.LAW_MEDIAN > Q.CUT


def test_texts_are_read_once(spark, odd_docs):
    """The filter on the counts does not evaluate them a second time, in Python workers of its own."""
    from pyspark.sql import functions as F
    kept = Q.quality_filter(odd_docs)
    vectors = Q.with_stats(odd_docs, "text", "st").where(~Q.base_failed(F.col("st"))).select("lang", "st.x")
    for df in (kept, vectors):
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
