"""Conversation repair against a search of all edit sequences."""

import hashlib
import random
import re
import zlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.llm import conversation_repair as cr
from moodlake.llm.common import read_table
from moodlake.llm.queries import op12_conversation_repair

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
SPACE = " \t\n\x0b\x0c\r"
GOOD = re.compile(r"(s?(ua)+)?")


def plain(v):
    return " " if v is None else str(v)


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = plain(role), plain(text)
        k = zlib.crc32(f"{plain(c)}:{plain(t)}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(c, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def brute(rows, price=5):
    """Digest of one conversation's rows after damage, by forward search over
    whole audit strings: all cheapest (cost, audit) per state, no pointers."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

    def insert(paths):      # at most two inserts in a row are ever useful
        for _ in range(2):
            more = [(c + price, a + "I", roles + i, lines + [f"{w}:"]) for c, a, roles, lines in paths
                    for i, w in (("u", "user"), ("a", "assistant"))]
            paths = prune(paths + more)
        return paths

    def prune(paths):       # one best path per regular-language state
        best = {}
        for p in paths:
            roles = p[2]
            if not re.fullmatch(r"s?(ua)*u?", roles):
                continue
            state = "" if not roles else roles[-1]
            if state not in best or (p[0], p[1]) < best[state][:2]:
                best[state] = p
        return list(best.values())

    paths = insert([(0, "", "", [])])
    for (_, _, role, text), fault in zip(rows, faults):
        new = []
        for c, a, roles, lines in paths:
            new.append((c + 2, a + "D", roles, lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if role[:1] in ("s", "u", "a"):
                new.append((c + extra, a + "K", roles + role[0], lines + [f"{role}:{text}"]))
            for w in ("user", "assistant"):
                new.append((c + extra + 1, a + "R", roles + w[0], lines + [f"{w}:{text}"]))
        paths = insert(prune(new))
    cost, audit, _, lines = min(p for p in paths if GOOD.fullmatch(p[2]))
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    after = damaged(rows)
    return {c: brute([r for r in after if r[0] == c]) for c in {r[0] for r in rows}}


def digests(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_random_conversations(spark):
    rnd = random.Random(3)
    words = ["a.", "b?", "c", "", " \t", "a.\n", "d!", "\u00a0", "x. y", None]
    rows = [(c, rnd.choice([None, *range(12)]), rnd.choice(["user", "assistant", "system", "tool", "", "ass", "U", None]),
             rnd.choice(words)) for c in [None, *range(300)] for _ in range(rnd.randint(1, 12))]
    df = spark.createDataFrame(rows, ROWS)
    got = digests(cr.audit(cr.damage(df)))
    want = expected(rows)
    assert got == want
    assert any(not v[6] for v in want.values()) and {x for v in want.values() for x in v[6]} == set("DKR")


def test_cheap_inserts(monkeypatch):
    """At the contract's prices deleting a neighbour always beats an insert, so
    the passes are also run with inserts at 1, on plain frames."""
    monkeypatch.setattr(cr, "INSERT", 1)
    monkeypatch.setattr(cr, "LAST", (0, 2, 1, 0))
    cr._choices.cache_clear(), cr._back.cache_clear()
    rnd, seen = random.Random(8), ""
    for _ in range(400):
        rows = [(1, i, rnd.choice(["user", "assistant", "system", "tool"]), rnd.choice(["a", "b."]) + f"{i}.")
                for i in range(rnd.randint(1, 9))]
        df = pd.DataFrame({"conv": "1", "turn_text": [str(r[1]) for r in rows], "alive": True, "role": [r[2] for r in rows],
                           "text": [r[3] for r in rows], "fault": ""})
        back = next(cr._pointers([df[::-1].reset_index(drop=True)]))
        got = list(cr._audited([back[::-1].reset_index(drop=True)]))[-1].iloc[0]
        want = brute(rows, 1)
        assert (got.audit, got.repaired_sha256) == want[6:]
        seen += got.audit
    cr._choices.cache_clear(), cr._back.cache_clear()
    assert set("IKR") <= set(seen)


def test_state_crosses_batches_in_a_giant_conversation(spark):
    rnd = random.Random(4)
    rows = [(7 if i % 3 else i, i, rnd.choice(["user", "assistant"]), rnd.choice(["Yes.", "no", "why?"]) + " " * (i % 5) + str(i) + ".")
            for i in range(4000)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        assert digests(cr.audit(cr.damage(spark.createDataFrame(rows, ROWS)))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_repaired_rows_give_the_digest(spark):
    rnd = random.Random(6)
    rows = [(c, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b", "c?", ""])) for c in range(60)
            for t in range(rnd.randint(1, 7))]
    df = cr.damage(spark.createDataFrame(rows, ROWS))
    edits = cr.repair(df).orderBy("conv_id", "position").collect()
    for conv, want in digests(cr.audit(df)).items():
        mine = [e for e in edits if e.conv_id == conv]
        kept = [e for e in mine if e.edit != "D"]
        assert "".join(e.edit for e in mine) == want[6]
        assert GOOD.fullmatch("".join(e.role[0] for e in kept))
        assert hashlib.sha256("\n".join(f"{e.role}:{e.text}" for e in kept).encode()).hexdigest() == want[7]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], ROWS)
    assert cr.audit(cr.damage(empty)).collect() == [] and cr.repair(empty).collect() == []
    long = "x" * 300_000 + "."
    rows = [(2 ** 62 + 1, None, None, None), (2 ** 62 + 1, 5, "user", long), (2 ** 62, 1, "assistant", "a" + " " * 100_000),
            (None, -2 ** 63, "user", "."), (None, 2 ** 63 - 1, "user", "."), (None, 0, "user", ".")]
    df = spark.createDataFrame(rows, ROWS)
    want = {c: (min(v[0], 2 ** 63 - 1), *v[1:]) for c, v in expected(rows).items()}
    assert digests(cr.audit(cr.damage(df))) == want
    odd = df.select("*", *[F.lit("odd").alias(c) for c in ("conv", "fault", "pointers", "copy", "luck", "turn_text", "position")])
    assert digests(cr.audit(cr.damage(odd))) == want
    # Undamaged use: every row counts, a conversation without valid turns is emptied.
    gone = spark.createDataFrame([(1, 1, "tool", ""), (1, 2, "user", "hi.")], ROWS)
    assert cr.audit(gone).first().audit == "DD"


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert digests(op12_conversation_repair(spark, sf_dir)) == expected(rows)


def test_one_shuffle(spark, sf_dir):
    df = op12_conversation_repair(spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
