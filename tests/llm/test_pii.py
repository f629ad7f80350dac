import hashlib
import re

from pyspark.sql import functions as F

from moodlake.llm import pii
from moodlake.llm.common import read_table
from moodlake.llm.queries import op5_personal_data

from tests.conftest import SF_MID

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            h, d = m.group(0), re.sub("[^0-9]", "", m.group(0))
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in h.split("."))
                    or kind == "card" and 16 <= len(d) <= 19 and luhn(d) or kind == "phone" and 8 <= len(d) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


ODD = ["a@b.c_d@e.f x@y.z@w.v", "a@b..c a@b.c.d. @b.c a@@b.c %+-@q-.r", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.01.1 1.2.3",
       "99999999999.1.1.1 1.2.3.4-5.6.7.8", "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111111",
       "4111  1111 1111 1111", "+1 (555) 123-4567 ++49 30 1234567 +1)) +123 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
       "é😀 joe@x.org 😀 10.0.0.1é", "9" * 20_000, "a" * 50_000 + "@b.c", "1.1" * 3000, "a@" + "b." * 9000 + "c",
       "4 1" * 4000, "+" + "1 " * 5000 + "x", "", None]


def test_base_spans_of_odd_texts(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    for r in pii.digest(df).collect():
        want = brute(ODD[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (r.doc_id, r.spans[:200], want[:5])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in PATTERNS]


def test_query_base_spans(spark):
    texts = {r.doc_id: r.text for r in read_table(spark, SF_MID, "documents").collect()}
    rows = op5_personal_data(spark, SF_MID).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.spans.split(",")[:len(want)] == (want or [""])[:len(want)]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 50


def corpus():
    """Three reports name joe@x.org's nickname beside different words; common words stand everywhere."""
    plain = [(i, f"the report of day{i} was sent to the office and filed by the clerk") for i in range(40)]
    told = [(100 + i, f"the {w} wrote to joe@x.org alias Zorbax about the {v}")
            for i, (w, v) in enumerate([("clerk", "report"), ("office", "day"), ("guard", "gate"), ("cook", "soup")])]
    copies = [(200 + i, "the singer met ann@y.org alias Quibble on stage") for i in range(5)]
    return plain + told + copies


def test_disclosing_terms(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.digest(df).collect()}
    text = dict(corpus())
    for i in range(100, 104):
        spans = [s.split(":") for s in found[i].spans.split(",")]
        words = [text[i][int(a):int(b)] for k, a, b in spans if k.startswith("term")]
        # The words found with the entity only; those of every report are kept.
        assert "Zorbax" in words and "the" not in words and "report" not in words
    # Copies of one place are one context: nothing is proven by them.
    assert all("term" not in found[200 + i].spans for i in range(5))
    assert all(found[i].spans == "" for i in range(40))


def test_disclosure_is_the_formula(spark):
    import math
    df = spark.createDataFrame(corpus(), "doc_id long, text string").cache()
    rows = pii.disclosing_terms(df).select(F.explode("terms").alias("t")).select("t.*").distinct().collect()
    got = {r.term: r.disclosure for r in rows}
    assert math.isclose(got["zorbax"], 1.0)
    n, docs = 49, [t.lower().split() for _, t in corpus()]
    about = math.log(n * 4 / (4 * sum("about" in d for d in docs))) / math.log(n / 4)
    assert math.isclose(got["about"], about)
    assert all(v >= pii.GENERALISE for v in got.values())


def test_sanitise(spark, odd_docs, no_docs):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert out[0] == corpus()[0][1] and "[EMAIL]" in out[100]
    assert "Zorbax" not in out[100] and "joe" not in out[100] and "report" in out[100]
    odd = pii.sanitise(odd_docs)
    assert odd.columns == odd_docs.columns
    by = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    assert by[4] is None and by[5] == "" and by[14] == "mail [EMAIL] or [PHONE] from [IP] card [CARD] end"
    assert odd.count() == odd_docs.count() and pii.sanitise(no_docs).collect() == [] and pii.digest(no_docs).collect() == []


def test_overlapping_spans_merge(spark):
    spans = "array(named_struct('kind','card','start',1,'end',5), named_struct('kind','phone','start',0,'end',3))"
    assert spark.range(1).select(pii.redacted(F.lit("abcdefg"), F.expr(spans))).first()[0] == "[PHONE]fg"
