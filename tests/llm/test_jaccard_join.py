import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from moodlake.llm import jaccard_join as J
from moodlake.llm.common import read_table
from moodlake.llm.components import components
from moodlake.llm.queries import op1_jaccard_join

from tests.conftest import SF_SMALL
from tests.llm.conftest import prose

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    """Set sizes and the smallest index reachable by links."""
    sets = [shingles(t) for t in texts]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    shared = Counter((a, b) for ids in where.values() for k, a in enumerate(ids) for b in ids[k + 1:])
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def test_query_matches_brute_force(spark):
    docs = read_table(spark, SF_SMALL, "documents").orderBy("doc_id").select("doc_id", "text").collect()
    sizes, roots = brute([d.text for d in docs])
    want = {d.doc_id: (n, docs[r].doc_id) for d, n, r in zip(docs, sizes, roots)}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op1_jaccard_join(spark, SF_SMALL).collect()}
    assert got == want and len({c for _, c in got.values()}) < len(got)


def test_groups_of_near_copies_passages_and_thresholds(spark, monkeypatch):
    monkeypatch.setattr(J, "SAMPLE", 1)     # every text is looked at for frequent shingles
    passage = prose(99, 60)
    texts = []
    base = prose(5, 80).split()
    for i in range(30):     # near copies at growing distance, some below the threshold
        w = list(base)
        for k in range(i % 6):
            w[7 + 13 * k] = f"edit{i}"
        texts.append(" ".join(w))
    texts += [prose(100 + i, 90 + i) + " " + passage for i in range(25)]    # share a passage only
    texts += [prose(200 + i // 2, 50) + (" tail" * (i % 2)) for i in range(20)]
    texts += ["one two three", "One Two THREE", "one two", ""]
    sizes, roots = brute(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(df, tile=7).collect()}   # tiles are cut into blocks
    assert got == {i: (n, r) for i, (n, r) in enumerate(zip(sizes, roots))}


def test_odd_rows(odd_docs, no_docs):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(odd_docs).collect()), key=str)
    by = {i: c for i, _, c in got if i is not None}
    assert len(got) == odd_docs.count()
    assert by[1] == by[2] == by[3] == by[15] == 1 and by[8] == 7 and by[11] == 10
    assert [by[i] for i in (4, 5, 6)] == [4, 5, 6] and all(n == 0 for i, n, _ in got if i in (4, 5, 6))
    # Rows without an id: one joins the copies, the other stays alone without a smallest id.
    assert sorted(str(c) for i, _, c in got if i is None) == ["1", "None"]
    assert J.jaccard_components(no_docs).collect() == []


def test_deduplicate_keeps_one_of_each_group(odd_docs, no_docs):
    kept = J.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 4, 5, 6, None, 7, 9, 10, 12, 13, 14], key=str)
    assert J.deduplicate(no_docs).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 13, 100])
def test_prefix_and_overlap_bounds(n):
    low = -(-75 * n // 100)
    assert J.prefix_length(n) == n - low + 1
    for m in range(low, n + 1):
        need = J.needed(n, m)
        assert 100 * need >= 75 * (n + m - need) and 100 * (need - 1) < 75 * (n + m - need + 1)
        assert need >= low or m < low


def test_a_large_group_needs_pairs_in_proportion_and_loses_no_link(spark, monkeypatch):
    """Hundreds of different near copies: a few best partners each, not all pairs; ``class_links`` gives all."""
    base = prose(8, 120).split()
    texts = []
    for i in range(300):
        w = list(base)
        w[(i * 7) % 120], w[(i * 31 + 5) % 120] = f"one{i}", f"two{i % 9}"
        texts.append(" ".join(w))
    texts += [prose(300 + i, 70) for i in range(40)] + texts[:5]
    sizes, roots = brute(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    seen = []
    pairs = J.Joined.pairs

    def counted(self, rows, best, tile):
        out = pairs(self, rows, best, tile)
        seen.append((best, out.count()))
        return out

    monkeypatch.setattr(J.Joined, "pairs", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(df).collect()}
    assert got == {i: (n, r) for i, (n, r) in enumerate(zip(sizes, roots))}
    assert sum(n for _, n in seen) < 40 * 300 and len(seen) > 1
    links, members = J.class_links(df)
    cls = {r.doc_id: r.cls for r in members.collect()}
    sets = [shingles(t) for t in texts]
    want = {tuple(sorted((cls[a], cls[b]))) for a in range(len(texts)) for b in range(a)
            if cls[a] != cls[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert {tuple(sorted((r.a, r.b))) for r in links.collect()} == want and len(want) > 1000


def test_clashing_column_names(spark):
    df = spark.createDataFrame([(1, prose(1, 40), "x", "y"), (2, prose(1, 40), "x", "y"), (2, prose(1, 40), "x", "y")],
                               "doc_id long, text string, g_id string, g_key string")
    assert [tuple(r)[0] for r in J.deduplicate(df).collect()] == [1]


@pytest.mark.parametrize("best", [None, 1, 3])
def test_pairs_of_many_tiles_are_compared_at_once(monkeypatch, best):
    """The pairs of each asker, as one by one; bitmaps of a batch's tiles meet in a few steps, not one for each asker."""
    r = np.random.default_rng(4)
    base = {n: np.unique(r.integers(0, 1 << 63, n).astype(np.uint64)) for n in (9, 17, 40, 47, 130, 150)}
    rows = []
    for cls in range(900):
        n = r.choice(list(base))
        s = base[n].copy()
        s[: r.integers(0, n // 3)] += np.uint64(cls)
        asks = bool(r.integers(0, 3))
        rows.append((int(r.integers(-60, 60)) ** 3, asks, not asks or bool(r.integers(0, 2)), cls, len(np.unique(s)), cls % 7, J.coarse(J.bitmap(s)).tobytes()))
    table = pd.DataFrame(rows, columns=["tile", "asks", "offers", "cls", "n", "comp", "bits"]).sort_values(["tile", "n", "cls"], ignore_index=True)
    want = set()
    for x in table.itertuples():
        got = []
        for y in table[(table["tile"] == x.tile) & (table.index < x.Index)].itertuples():
            a, b = np.frombuffer(x.bits, np.uint8), np.frombuffer(y.bits, np.uint8)
            if x.asks and y.offers and x.comp != y.comp and 100 * y.n >= 75 * x.n and len(a) <= 2 * len(b):
                width = min(len(a), len(b))
                differ = int(np.bitwise_count(J.folded(a, width) ^ J.folded(b, width)).sum())
                slack = (x.n + y.n - differ) // 2 - J.needed(x.n, y.n)
                got += [(-slack, y.cls)] if slack >= 0 else []
        more = best is not None and len(got) > best
        want |= {(x.cls, other, more) for _, other in sorted(got)[:best]}
    steps, differing = [], J.differing
    monkeypatch.setattr(J, "differing", lambda x, y: steps.append(len(x)) or differing(x, y))
    assert set(J.tile_pairs(table, best).itertuples(index=False, name=None)) == want and len(want) > 100
    assert len(steps) < 20
    monkeypatch.setattr(J, "PAIRS", 5)
    monkeypatch.setattr(J, "COMPARED_BYTES", 40)
    assert set(J.tile_pairs(table, best).itertuples(index=False, name=None)) == want
    assert len(J.tile_pairs(table[:0], best)) == 0
