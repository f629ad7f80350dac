"""Vector codes against plain integer k-means, and the tree against all distances."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.llm import vector_codes as vc
from moodlake.llm.common import read_table
from moodlake.llm.queries import op13_vector_codes

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                     T.StructField("label", T.IntegerType())])


def brute(rows):
    kept = [(i, [math.floor(4096 * float(x)) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(kept[0][1]) // 8
    books = [[r[1][p * d:(p + 1) * d] for r in kept[:16]] for p in range(8)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(books[p]))

    for _ in range(6):
        for p in range(8):
            own = [[] for _ in books[p]]
            parts = [r[1][p * d:(p + 1) * d] for r in kept]
            for x in parts:
                own[near(p, x)[1]].append(x)
            books[p] = [[sum(c) // len(o) for c in zip(*o)] if o else e for o, e in zip(own, books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, labels = [], {}
    for i, v, label in kept:
        best = [near(p, v[p * d:(p + 1) * d]) for p in range(8)]
        error = min(sum(b[0] for b in best), 2 ** 63 - 1)
        labels[label] = min(labels.get(label, 0) + error, 2 ** 63 - 1)
        out.append((i, "".join(f"{b[1]:02x}" for b in best), error, label))
    return sorted(((i, c, e, labels[lab], digest) for i, c, e, lab in out), key=str)


def same(got, rows):
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_tree_equals_all_distances_and_skips_some():
    rnd = np.random.default_rng(1)
    for dtype in (np.int64, object):
        for k, spread in ((1, 5), (3, 5), (16, 3), (16, 1000), (60, 40), (60, 2)):
            centres = rnd.integers(-5000, 5000, (6, 4))
            entries = (centres[rnd.integers(0, 6, k)] + rnd.integers(-spread, spread + 1, (k, 4))).astype(dtype)
            queries = (centres[rnd.integers(0, 6, 300)] + rnd.integers(-spread, spread + 1, (300, 4))).astype(dtype)
            tree = vc.Gnat(entries)
            index, best = tree.nearest(queries)
            every = ((queries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
            assert (best == every.min(axis=1)).all()
            assert [int(i) for i in index] == [list(r).index(r.min()) for r in every]
            if k == 60 and spread == 40:
                assert tree.measured < 0.6 * every.size


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").collect()]
    same(op13_vector_codes(spark, sf_dir), rows)


def test_odd_vectors(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, i, i // 2]), [rnd.choice([-1.0, 0.0, 0.5, rnd.uniform(-2, 2)]) for _ in range(16)],
             rnd.choice([None, 1, 2])) for i in range(120)]
    rows += rows[:7]
    bad = [(1, None, 1), (2, [], 1), (3, [float("nan")] * 16, 1), (4, [float("inf")] + [0.0] * 15, 2), (5, [None] + [0.0] * 15, 2),
           (0, [1.0] * 24, 1), (0, [1.0] * 7, 1)]
    df = spark.createDataFrame(rows + bad, ROWS)
    same(vc.compress(df), rows)
    odd = df.select("*", *[F.lit("odd").alias(c) for c in ("v", "code", "error", "of", "part")])
    same(vc.compress(odd), rows)
    few = rows[:5]
    same(vc.compress(spark.createDataFrame(few, ROWS)), few)
    assert vc.compress(spark.createDataFrame([], ROWS)).collect() == []
    assert vc.compress(spark.createDataFrame(bad[:5], ROWS)).collect() == []


def test_components_whose_squares_pass_a_long(spark):
    rows = [(i, [float(np.float32((-1) ** i * (i + 1) * 3.0e6 * (j + 1))) for j in range(8)], i % 3) for i in range(40)]
    same(vc.compress(spark.createDataFrame(rows, ROWS)), rows)
    huge = [(i, [3.0e38 * (-1) ** i] * 8, None) for i in range(20)]
    assert vc.compress(spark.createDataFrame(huge, ROWS)).count() == 20
