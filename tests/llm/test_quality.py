import random
import re
from collections import Counter

import numpy as np

from moodlake.llm import quality as Q
from moodlake.llm.common import read_table
from moodlake.llm.queries import op10_quality

from tests.conftest import SF_MID
from tests.llm.conftest import prose


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    many = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in many for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_counts_against_brute_force():
    texts = [None, "", " \n ", "a", "x " * 30, "a b c d e f g h a b c d e f g h", "é ü\n\nl\nl\n é\n", "#$ %% |<>&*",
             "one two three four five six seven eight nine " * 3, prose(1, 200) + "\n" + prose(1, 50)]
    for t in texts:
        assert Q.text_stats(t)[:5] == brute_counts(t), t


def test_query_counts_and_verdicts(spark):
    """Base counts equal brute force; clean labelled documents stay, most bad ones go."""
    docs = {r.doc_id: r for r in read_table(spark, SF_MID, "documents").collect()}
    label = {r.doc_id: r.quality for r in read_table(spark, SF_MID, "labels").collect()}
    rows = op10_quality(spark, SF_MID).collect()
    assert len(rows) == len(docs)
    kept = Counter()
    for r in rows:
        want = brute_counts(docs[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.base_failed and r.kept)
        if not r.base_failed:
            kept[label.get(r.doc_id), r.kept] += 1
    assert kept[1, True] / (kept[1, True] + kept[1, False]) > 0.99
    assert kept[0, False] / (kept[0, True] + kept[0, False]) > 0.85


def test_determinant_withstands_outliers(spark):
    """A fifth of outliers does not move the estimate; brute force finds the same outliers."""
    r = np.random.default_rng(0)
    x = r.normal(0, 1, (600, Q.D)) * UNITS + 1000
    x[:120] += 40 * UNITS
    rows = spark.createDataFrame([("g", row.round().astype(int).tolist()) for row in x], "k string, x array<int>")
    got = Q.scatter(rows, ["k"]).first()
    good = x[120:]
    assert np.abs(np.array(got["mean"]) - good.mean(axis=0)).max() < 0.3 * UNITS.max()
    inv = np.zeros((Q.D, Q.D))
    inv[np.triu_indices(Q.D)] = got["inv"]
    d = x - np.array(got["mean"])
    d2 = np.einsum("ij,jk,ik->i", d, inv, d)
    assert d2[:120].min() > Q.CUT > d2[120:].max()


UNITS = np.array(Q.FLOOR) * Q.UNIT * 4


def test_odd_rows(odd_docs, no_docs):
    rows = Q.quality_report(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (4, 5, 6, 7, 8))
    twins = [r for r in rows if r.doc_id == 2]
    assert twins[0] == twins[1]
    kept = Q.quality_filter(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.kept for r in rows)
    assert Q.quality_report(no_docs).collect() == []


def test_small_groups_use_their_language(spark):
    random.seed(3)
    rows = [("en", f"s{i % 3}", [random.randrange(1000, 1100) for _ in range(Q.D)]) for i in range(60)] + [
        ("de", "s0", [random.randrange(2000, 2100) for _ in range(Q.D)]) for _ in range(5)]
    est = Q.group_estimates(spark.createDataFrame(rows, "lang string, source string, x array<int>"), min_group=30)
    got = {(r.lang, r.source): r.mean[0] for r in est.collect()}
    assert len({got["en", f"s{i}"] for i in range(3)}) == 1 and 1000 < got["en", "s0"] < 1100
    assert got["de", "s0"] < 1500    # five documents: the estimate of all


def test_a_concentration_step_reads_its_rows_once(spark, monkeypatch):
    from pyspark.sql import functions as F
    from moodlake.llm import quality
    rng = np.random.default_rng(8)
    x = [(str(i % 2), [int(v) for v in rng.integers(0, 900, quality.D)]) for i in range(120)]
    rows = spark.createDataFrame(x, "k string, x array<int>")
    plans, write = [], quality.materialize

    def seen(df, name):
        if name in ("concentration", "reweighted"):
            plans.append(df._jdf.queryExecution().executedPlan().toString().count("Join "))
        return write(df, name)

    monkeypatch.setattr(quality, "materialize", seen)
    quality.scatter(rows, ["k"]).collect()
    assert plans == [1] * (quality.STEPS + 1)
    # The same sums as rows kept by the edge of their group.
    d = rows.withColumn("step", (F.col("x")[0] / 100).cast("int"))
    for share, margin in ((0.75, 0), (0.5, 2)):
        edge = quality._share_step(d, ["k"], "step", share)
        inside = quality._joined(d, edge, ["k"]).where(F.col("step") <= F.col("edge") + margin)
        want = quality._moments(inside, ["k"], F.col("x")).orderBy("k").collect()
        assert quality._moments_inside(d, ["k"], share, margin).orderBy("k").collect() == want
