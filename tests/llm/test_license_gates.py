"""The keyword and stem gates of the license scan lose nothing of the rules run without any gate."""

import re
from itertools import islice, product

from moodlake.llm import license_scan

TEXTS = ["This is under the GNU Library General Public License version 2 or later", "the Expat License applies",
         "PNG Reference Library License", "released into the public\ndomain", "do what\nthe heck you want to public license",
         "Open\nSoftware License", "all\nrights\n reserved by us", "Creative\nCommons Attribution\nShareAlike",
         "MIT No\nAttribution", "the zero-clause BSD", "proprietary and\nconfidential", "python software foundation licence",
         "SPDX-License-Identifier: PSF-2.0", "https://example.org/legalcode/mit", "GNU\tGPL version 3", "cc by-sa"]


def samples(pattern):
    """Texts that the parsed pattern matches: every alternative, optional parts with and without, line ends as white space."""
    def one(op, arg):
        op = str(op)
        if op == "LITERAL":
            return [chr(arg)]
        if op == "IN":
            if str(arg[0][0]) == "CATEGORY":
                return ["\n" if "SPACE" in str(arg[0][1]) else "x"]
            return [chr(a if str(o) == "LITERAL" else a[0]) for o, a in arg if str(o) in ("LITERAL", "RANGE")]
        if op == "BRANCH":
            return [s for x in arg[1] for s in every(x)]
        if op == "SUBPATTERN":
            return every(arg[-1])
        if op in ("MAX_REPEAT", "MIN_REPEAT"):
            return [""] * (arg[0] == 0) + [s * max(1, arg[0]) for s in every(arg[2])]
        assert op in ("AT", "ASSERT_NOT"), op
        return [""]

    def every(items):
        return ["".join(x) for x in islice(product(*[one(op, arg) for op, arg in items]), 2000)]

    return every(re._parser.parse(pattern))


def test_gates_hold_in_every_alternative():
    for _, label, key, pattern, _ in license_scan.rules():
        texts = [t for t in samples(pattern) if re.search(pattern, t)]
        assert texts, pattern
        for t in texts:
            assert key in t.lower() and any(s in t.lower() for s in license_scan.STEMS), (label, key, t)


def test_scan_equals_ungated_rules(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in license_scan.scan(df).collect():
        text = TEXTS[r.doc_id]
        found = sorted((m.start(), -m.end(), prio, label) for prio, label, _, pattern, _ in license_scan.rules()
                       for m in re.finditer(pattern, text))
        kept, reach = [], -1
        for s, e, prio, label in found:
            if -e > reach:
                kept.append((s, -e, prio, label))
                reach = -e
        want = [d for i, d in enumerate(kept)
                if not (i and kept[i - 1][1] > d[0] and kept[i - 1][2] < d[2])
                and not (i + 1 < len(kept) and kept[i + 1][0] < d[1] and kept[i + 1][2] < d[2])]
        assert [(d.start, d.end, d.prio, d.label) for d in r.detections] == want and want, text
    rows = {TEXTS[r.doc_id]: r.labels for r in license_scan.scan(df).collect()}
    assert rows[TEXTS[0]] == ["gpl", "lgpl-2.0"] and rows[TEXTS[1]] == ["mit"] and rows[TEXTS[2]] == ["libpng"]
    assert rows[TEXTS[3]] == ["public-domain"] and rows[TEXTS[10]] == ["proprietary"]


def test_suppression_resolves_in_priority_order(spark):
    """Chains: a detection that goes suppresses nothing. Against a plain greedy choice."""
    import random
    from pyspark.sql import functions as F
    from moodlake.llm.license_scan import suppressed

    def brute(found):
        wide = [d for d in found if not any(o != d and o[0] <= d[0] and o[1] >= d[1] and (
            (o[0], o[1]) != (d[0], d[1]) or o[2] < d[2]) for o in found)]
        out = []
        for d in sorted(wide, key=lambda d: (d[2], d[0])):
            if not any(k[0] < d[1] and d[0] < k[1] for k in out):
                out.append(d)
        return sorted(out)

    r = random.Random(2)
    cases = [[(0, 10, 1), (8, 20, 2), (18, 30, 3)], [(0, 10, 2), (8, 20, 1), (18, 30, 3)], []]
    for _ in range(150):
        spans = {(s := r.randint(0, 60), s + r.randint(1, 15), p) for p in range(r.randint(0, 12))}
        cases.append(sorted(spans))
    rows = [(i, [(*d, f"l{d[2]}", 0.5) for d in c]) for i, c in enumerate(cases)]
    df = spark.createDataFrame(rows, "id int, f array<struct<start:int,end:int,prio:int,label:string,strength:double>>")
    got = {x.id: [tuple(d)[:3] for d in x.out] for x in df.select("id", suppressed(F.col("f")).alias("out")).collect()}
    assert got == {i: brute(c) for i, c in enumerate(cases)}
    assert [d[:2] for d in got[0]] == [(0, 10), (18, 30)]


def test_a_text_of_thousands_of_mentions(spark):
    """Work grows with the mentions of a text, not with their square."""
    import time
    from moodlake.llm import license_scan

    def seconds(n):
        df = spark.createDataFrame([(1, "This file is under the MIT License and more words here. " * n)], "doc_id long, text string")
        t = time.perf_counter()
        row = license_scan.digest(license_scan.scan(df)).first()
        assert row.labels == "mit"
        return time.perf_counter() - t

    seconds(10)
    assert seconds(4000) < 40
