"""Texts of thousands of spans, and lists of many entities and words in several versions."""

import random
import time
from collections import defaultdict
from itertools import accumulate

from pyspark.sql import functions as F

from moodlake.llm import pii
from moodlake.llm.common import read_table
from moodlake.llm.spans import BLOCK, CHUNK, replaced, running

from tests.conftest import SF_SMALL
from tests.llm.test_pii import brute, corpus


def directory(n, tag=""):
    return f"version {tag} " + " ".join(f"name{i}q u{i}@x{i % 7}.org" for i in range(n))


def test_running_folds_over_blocks(spark):
    for n in (0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 5 * BLOCK + 3):
        r = random.Random(n)
        v = [r.randrange(100) for _ in range(n)]
        df = spark.createDataFrame([(v,)], "v array<int>")
        add, most = df.select(running(F.col("v"), lambda a, b: a + b), running(F.col("v"), F.greatest)).first()
        assert add == ([0] + list(accumulate(v)))[:n] and most == ([0] + list(accumulate(v, max)))[:n]


def test_replaced_against_brute_force(spark):
    r = random.Random(4)
    for n in (0, 1, CHUNK - 1, CHUNK, CHUNK + 1, 4 * CHUNK + 7):
        text = "".join(r.choice("aé😀\n ") for _ in range(n))
        spans = [(a, min(n, a + r.randrange(1, 9))) for a in (r.randrange(max(n, 1)) for _ in range(min(n, 500)))]
        spans += [(0, n)] * (n == 1) + [(n - 3, n)] * (n > 3)
        want, at = "", 0
        for a, b in sorted(spans):
            if a >= at:
                want += text[at:a] + "[X]"
            at = max(at, b)
        df = spark.createDataFrame([(text, spans)], "t string, s array<struct<start:int,end:int>>")
        assert df.select(replaced(F.col("t"), F.col("s"), lambda s: F.lit("[X]"))).first()[0] == want + text[at:]


def test_time_is_linear_in_the_spans(spark):
    took = {}
    for n in (200, 20_000):
        df = spark.createDataFrame([(1, directory(n))], "doc_id long, text string").cache()
        df.count()
        t = time.time()
        spans = pii.base_spans(F.col("text"))
        size, red = df.withColumn("s", spans).select(F.size("s"), pii.redacted(F.col("text"), F.col("s"))).first()
        took[n] = time.time() - t
        assert size == n and red == "version  " + " ".join(f"name{i}q [EMAIL]" for i in range(n))
    assert took[20_000] < 100 * max(took[200], 0.3)


def test_many_entities_and_words_are_one_pair(spark):
    rows = [(i, directory(3000, v)) for i, v in enumerate(("alpha", "beta", "gamma", "delta"))]
    rows += [(10 + i, f"plain text of day{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.disclosing_terms(df).select(F.transform("terms", lambda t: t["term"]).alias("t")).collect()
    assert len(found) == 4 and all(set(r.t) == {"version", *(f"name{i}q" for i in range(3000))} for r in found)


def brute_disclosure(rows):
    """Per text its words' largest disclosure at or above the threshold, every pair looked at."""
    import math
    import re
    word = re.compile(r"[^\W\d_](?:[^\W_]|')*")
    n, docs_e, docs_t, joint, held = len(rows), defaultdict(int), defaultdict(int), defaultdict(lambda: [0, set()]), {}
    for t in rows:
        spans = [s.split(":") for s in brute(t)]
        at, out = 0, ""
        for _, a, b in sorted(spans, key=lambda s: (int(s[1]), int(s[2]))):
            if int(a) >= at:
                out += t[at:int(a)] + " "
            at = max(at, int(b))
        ents = {f"{k}:{t[int(a):int(b)].lower()}" for k, a, b in spans}
        near = set(word.findall((out + t[at:]).lower()))
        for w in set(word.findall(t.lower())):
            docs_t[w] += 1
        for e in ents:
            docs_e[e] += 1
            for w in near:
                joint[e, w][0] += 1
                joint[e, w][1].add(t)
        held[t] = (ents, near)
    out = {}
    for t, (ents, near) in held.items():
        got = {}
        for e in ents:
            for w in near:
                both, texts = joint[e, w]
                if len(texts) >= pii.MIN_CONTEXTS and docs_e[e] < n:
                    d = math.log(n * both / (docs_e[e] * docs_t[w])) / math.log(n / docs_e[e])
                    if d >= pii.GENERALISE - 1e-12:
                        got[w] = max(got.get(w, 0), d)
        if got:
            out[t] = got
    return out


def test_disclosure_against_brute_force(spark):
    r = random.Random(8)
    texts = [t for _, t in corpus()]
    for i in range(150):
        words = [f"w{chr(97 + r.randrange(26))}{chr(97 + r.randrange(4))}" for _ in range(12)]
        mails = [f"m{r.randrange(12)}@h.org" for _ in range(r.randrange(4))]
        extra = [f"nick{m[1:m.index('@')]}" for m in mails if r.random() < 0.9]
        texts.append(" ".join(r.sample(words + mails + extra, len(words + mails + extra))))
    texts += texts[-20:]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    k1, k2 = pii._keys(F.col("text"))
    key = {(x.a, x.b): x.text for x in df.select("text", k1.alias("a"), k2.alias("b")).collect()}
    got = {key[x.k1, x.k2]: {t.term: t.disclosure for t in x.terms} for x in pii.disclosing_terms(df).collect()}
    want = brute_disclosure(texts)
    assert want and got.keys() == want.keys()
    for t, terms in want.items():
        assert got[t].keys() == terms.keys() and all(abs(got[t][w] - d) < 1e-9 for w, d in terms.items())


def test_words_beside_base_spans(spark):
    base = "array(named_struct('kind','ip','start',3,'end',11,'hit','10.0.0.1'))"
    terms = "array(named_struct('term','zed','disclosure',1.0D), named_struct('term','ab','disclosure',0.7D))"
    rows = {"ab 10.0.0.1zed": ["term:0:2"], "ab.10.0.0.1 zed": ["term:0:2", "term-removed:12:15"]}
    for text, want in rows.items():
        got = spark.range(1).select(pii._term_spans(F.lit(text), F.expr(base), F.expr(terms)).alias("s")).first().s
        assert [f"{s.kind}:{s.start}:{s.end}" for s in got] == want


def test_whole_texts_of_the_table(spark):
    """The text between spans stays as it was."""
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    s = pii.base_spans(F.coalesce(F.col("text"), F.lit("")))
    for r in docs.withColumn("s", s).withColumn("out", pii.redacted(F.col("text"), F.col("s"))).collect():
        want, at = "", 0
        for x in sorted(r.s, key=lambda x: (x.start, x.end)):
            if x.start >= at:
                want += r.text[at:x.start] + f"[{x.kind.upper()}]"
            at = max(at, x.end)
        assert r.out == (want + r.text[at:] if r.text is not None else None)
