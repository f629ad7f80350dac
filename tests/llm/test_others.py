"""Top-k search, toxicity, mixing, license scan, language identification and the pipeline."""

import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from moodlake.llm import language_id, license_scan, mixing, topk, toxicity
from moodlake.llm.common import read_table
from moodlake.llm.queries import op3_top_k, op6_toxicity, op7_mixture, op8_license_scan, op9_language

from tests.conftest import SF_MID, SF_SMALL


# --- top-k search ---

def brute_top_k(vectors, ask, k, scale):
    ints = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in vectors
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in ints:
        if ask(i):
            best = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in ints if j != i and len(x) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def test_top_k_query(spark):
    vectors = [(r.vec_id, r.embedding) for r in read_table(spark, SF_SMALL, "embeddings").collect()]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in op3_top_k(spark, SF_SMALL).collect())
    assert got == brute_top_k(vectors, lambda i: i % 50 == 0, 5, 256.0)


def test_top_k_odd_vectors(spark):
    r = random.Random(4)
    rows = [(i, [r.uniform(-1, 1) for _ in range(20)]) for i in range(200)]
    rows += [(200 + i, [1.0] * 20) for i in range(12)] + [(400, [0.0] * 20)]            # ties, zero
    rows += [(500, None), (501, []), (502, [1.0, None]), (503, [float("nan")] * 20), (504, [float("inf")] * 20),
             (None, [1.0] * 20), (505, [2.0, 3.0]), (506, [1.0, 1.0]), (507, [3e6] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    for block, shares in ((2048, 24), (7, 3)):
        got = topk.top_k(df, topk.F.col("id") % 5 == 0, 5, 256.0, query_block=block, shares=shares)
        assert sorted(tuple(x) for x in got.collect()) == brute_top_k(rows, lambda i: i % 5 == 0, 5, 256.0)
    assert topk.top_k(df.where("false"), topk.F.col("id") % 5 == 0, 5, 256.0).collect() == []


def test_segment_bounds_prune_and_never_exceed():
    r = np.random.default_rng(1)
    x = np.cumsum(r.integers(-50, 50, (400, 64)), axis=1)
    one = topk.Searcher(np.arange(4), x[:4], 3)
    for a in range(0, 400, 100):
        one.offer(np.arange(400)[a:a + 100], x[a:a + 100])
    assert one.measured < 4 * 399
    for cuts in topk.RESOLUTIONS:
        s = topk.segment_stats(x, cuts)
        low = ((s[:4, None] - s[None]) ** 2).sum(axis=2)
        assert (low <= ((x[:4, None] - x[None]).astype(float) ** 2).sum(axis=2) + 1e-6).all()


# --- toxicity ---

def letters():
    text = "the idiot moron clown was stupid and the loser had no soup at the table " * 50
    n = np.zeros(toxicity.ALPHABET ** 3)
    x = [0, 0] + [0 if c == " " else toxicity.letter(c) for c in text] + [0]
    for a, b, c in zip(x, x[1:], x[2:]):
        n[(a * toxicity.ALPHABET + b) * toxicity.ALPHABET + c] += 1
    n = n.reshape((toxicity.ALPHABET,) * 3)
    p2 = (n.sum(axis=0) + 0.1) / (n.sum(axis=0).sum(axis=1, keepdims=True) + 6)
    return np.log((n + 5 * p2[None]) / (n.sum(axis=2, keepdims=True) + 5)).astype(np.float32)


@pytest.mark.parametrize("written, meant", [
    ("1d10t", "idiot"), ("!diot", "diot"), ("m0r0n,", "moron"), ("s.t.u.p.i.d", "stupid"), ("c-l-0-w-n", "clown"),
    ("idiooooot", "idiot"), ("l o s e r", "loser"), ("the", "the"), ("soup.", "soup"), ("2024", ""), ("***", "")])
def test_deobfuscation(written, meant):
    # Signs at the edges are cut off before decoding.
    assert toxicity.restored_text(written, letters()) == meant


def test_decode_is_the_cheapest_path():
    m = letters()

    def every(token):
        paths = [(0.0, "")]
        for readings in toxicity.lattice(token):
            paths = [(c + e, t + x) for c, t in paths for x, e in readings]
        def cost(c, t):
            a = b = 0
            for x in t + " ":
                k = 0 if x == " " else toxicity.letter(x)
                c -= float(m[a, b, k])
                a, b = b, k
            return c
        return min((cost(c, t), t) for c, t in paths)[1]

    for token in ("m0r0n", "1d1.0t", "l o s e r", "cl00wwwn", "s+up!d"):
        assert toxicity.decode(token, m) == every(token)


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in read_table(spark, SF_MID, "labels").collect()}
    rows = op6_toxicity(spark, SF_MID).collect()
    assert len(rows) == read_table(spark, SF_MID, "documents").count()
    seen = Counter()
    for r in rows:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.5)
        if r.held_out and r.doc_id in labels:
            seen[labels[r.doc_id], r.predicted] += 1
    assert seen[0, 1] == 0 and seen[1, 1] >= 0.6 * (seen[1, 0] + seen[1, 1])


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, 1), (1, 0), (9, 0), (4, None), (None, 1), (14, 0)], "doc_id long, toxic int")
    for labels in (none, some):
        model = toxicity.learn(odd_docs, labels, toxicity.F.lit(True))
        rows = toxicity.score(odd_docs, model, keep={"doc_id": toxicity.F.col("doc_id")}).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (4, 5, 6)}) == 1
    model = toxicity.learn(no_docs, none, toxicity.F.lit(True))
    assert toxicity.score(no_docs, model).collect() == []


# --- language identification ---

def test_language_held_out(spark):
    docs = {r.doc_id: r for r in read_table(spark, SF_MID, "documents").collect()}
    rows = op9_language(spark, SF_MID).collect()
    assert len(rows) == len(docs)
    right = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert sum(right) / len(right) > 0.98 and all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_mixture_finds_shares():
    r = np.random.default_rng(2)
    p = r.dirichlet(np.full(200, 0.1), 3)
    g = r.choice(200, 4000, p=0.7 * p[0] + 0.3 * p[2])
    at, n = np.unique(g, return_counts=True)
    share, _ = language_id.mixture(p[:, at], n.astype(float), 200)
    assert abs(share[0] - 0.7) < 0.05 and share[1] < 0.02
    table = np.maximum(p, 1e-6).astype(np.float32)
    assert language_id.predict_one(g, table)[0] == 0


def test_language_odd_rows(odd_docs, no_docs):
    F = language_id.F
    model = language_id.learn(odd_docs)
    rows = {r.doc_id: r for r in language_id.predict(odd_docs, model, keep={"doc_id": F.col("doc_id")}).collect()}
    assert all((rows[i].lang_pred, rows[i].score) == ("und", 0.0) for i in (4, 5, 6, 13))
    assert rows[12].lang_pred in model[0] and 0 < rows[12].score <= 1
    nothing = language_id.learn(no_docs)
    assert {r.lang_pred for r in language_id.predict(odd_docs, nothing).collect()} == {"und"}
    assert language_id.predict(no_docs, model).collect() == []


# --- mixing ---

def test_mixture_against_numpy(spark):
    rows = [r.asDict() for r in op7_mixture(spark, SF_MID).collect()]
    assert len(rows) == read_table(spark, SF_MID, "documents").count()
    total = sum(r["tokens"] for r in rows)
    cells = defaultdict(int)
    for r in rows:
        cells[r["source"], r["lang"], r["topic"]] += r["tokens"]
    keys = [k for k, n in cells.items() if n]
    base = np.array([cells[k] / total for k in keys])
    share = base.copy()
    target = []
    for d in range(3):
        by = defaultdict(float)
        for k, b in zip(keys, base):
            by[k[d]] += b
        norm = sum(v ** mixing.TEMPER for v in by.values())
        target.append({v: b ** mixing.TEMPER / norm for v, b in by.items()})
    for _ in range(200):
        for d in range(3):
            have = defaultdict(float)
            for k, s in zip(keys, share):
                have[k[d]] += s
            share = np.minimum([s * target[d][k[d]] / have[k[d]] for k, s in zip(keys, share)], base / mixing.RATE)
    want = dict(zip(keys, share / base))
    for r in rows:
        if r["tokens"]:
            assert abs(r["weight"] - want[r["source"], r["lang"], r["topic"]]) < 0.02
        assert abs(r["probability"] - min(1, mixing.RATE * r["weight"])) < 1e-9
    drawn, expected = sum(r["drawn"] for r in rows), sum(r["probability"] for r in rows)
    assert abs(drawn - expected) < 4 * np.sqrt(len(rows) / 4)


def test_given_targets_and_odd_rows(spark, odd_docs, no_docs):
    target = spark.createDataFrame([("en", 0.5), ("fr", 0.5)], "value string, share double")
    rows = mixing.report(odd_docs, targets={"lang": target}).collect()
    assert len(rows) == odd_docs.count()
    # Languages without a target get nothing (their texts with tokens), and equal rows equal draws.
    assert all(r.weight == 0 and not r.drawn for r in rows if r.lang in ("de", None) and r.tokens)
    assert len({(r.weight, r.drawn) for r in rows if r.doc_id == 2}) == 1
    kept = mixing.sample(odd_docs)
    assert kept.columns == odd_docs.columns and mixing.sample(no_docs).collect() == []


def test_topic_is_the_most_frequent_long_word():
    assert mixing.topic_of("short words") == "none"
    assert mixing.topic_of("banana Banana cherry a 12") == f"topic{crc32(b'banana') % mixing.TOPICS}"
    assert mixing.topic_of("cherry banana") == f"topic{crc32(b'banana') % mixing.TOPICS}"


# --- license scan ---

PHRASES = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))
    hits = {label: [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p] for label, p in PHRASES.items()}
    places = sorted(x for v in hits.values() for x in v)
    return (len(words), len(places), places[0] if places else None, places[-1] if places else None,
            ",".join(sorted(k for k, v in hits.items() if v)))


def brute_detections(text):
    low, found = text.lower(), []
    if any(s in low for s in license_scan.STEMS):
        for prio, label, key, pattern, strength in license_scan.rules():
            if key in low:
                found += [(m.start(), -m.end(), prio, label) for m in re.finditer(pattern, text)]
    kept, reach = [], -1
    for s, e, prio, label in sorted(found):
        if -e > reach:
            kept.append((s, -e, prio, label))
            reach = -e
    return [d for i, d in enumerate(kept)
            if not (i and kept[i - 1][1] > d[0] and kept[i - 1][2] < d[2])
            and not (i + 1 < len(kept) and kept[i + 1][0] < d[1] and kept[i + 1][2] < d[2])]


LICENSES = [
    "Licensed under the Apache License, Version 2.0. SPDX-License-Identifier: Apache-2.0", "CC BY cc-by CC  BY-SA 4.0 accby ccby",
    "This work is licensed under the GNU General Public License, version 3", "All\nRights -- Reserved. ALL RIGHTS RESERVED",
    "see https://opensource.org/licenses/MIT or the MIT License; released under the MIT License", "GNU Lesser General Public License v2.1",
    "Creative Commons Attribution-NonCommercial 4.0 and CC0", "é CC BY é general public license", "no licence here", "", None,
    "cc by " * 3000, "General Public " * 500, "licensed " * 2000, "under the " * 50 + "BSD license"]


def test_license_rules_count_and_order():
    rules = license_scan.rules()
    assert len(rules) > 250 and [r[0] for r in rules] == list(range(len(rules)))
    assert all(re.compile(r[3]) for r in rules)


def test_licenses_against_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(LICENSES)), "doc_id long, text string")
    for r in license_scan.scan(df).collect():
        t = LICENSES[r.doc_id]
        want = brute_base(t)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, ",".join(r.base_labels)) == want, t
        found = brute_detections(t or "")
        assert [(d.start, d.end, d.prio, d.label) for d in r.detections] == found, t
        assert r.labels == sorted(set(r.base_labels) | {d[3] for d in found})
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_license_query(spark, odd_docs, no_docs):
    texts = {r.doc_id: r.text for r in read_table(spark, SF_MID, "documents").collect()}
    rows = op8_license_scan(spark, SF_MID).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(texts[r.doc_id])
        want = set(filter(None, r.base_labels.split(","))) | {d[3] for d in brute_detections(texts[r.doc_id])}
        assert r.labels == ",".join(sorted(want))
    assert sum(r.n_base for r in rows) > 10
    assert license_scan.scan(odd_docs).count() == odd_docs.count() and license_scan.scan(no_docs).collect() == []


# --- native operators ---

@pytest.mark.parametrize("name", ["op5_personal_data", "op8_license_scan"])
def test_native_plans_run_no_python(spark, name):
    from moodlake.llm.queries import queries
    plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
