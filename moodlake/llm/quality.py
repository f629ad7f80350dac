"""Quality rules: fixed limits, then robust multivariate outliers.

Base rules reject a document with fewer than ``MIN_WORDS`` words, or with more
than 30 % of its words inside 8-word windows that occur twice or more.

The others are described by a vector of transformed statistics (``DIMS``).
Per language and source the minimum covariance determinant estimates centre
and scatter: from two deterministic starts (coordinate-wise median and MAD;
spatial signs), concentration steps keep the ``H`` share of vectors with the
smallest Mahalanobis distance and re-estimate, the start with the smaller
determinant wins, one reweighting step follows, and the scatter is scaled, up
or down, so that the median distance is that of a multivariate t law with
``FREEDOM`` degrees of freedom. A document whose squared distance exceeds
``CUT``, that law's ``QUANTILE``, is rejected.

Every statistic is a partial aggregate over whole groups: vectors are held as
integers (1/256), sums are exact, and shares come from counts per distance
step, so results do not depend on partitioning and no group meets in one task.
Groups under ``MIN_GROUP`` documents use their language's estimate, smaller
languages that of all documents.

Defined results: a null or empty text has no words and fails the base rules; a
null language or source is a group of its own; repeated rows are judged each
and alike; an empty table gives no rows; extra columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.llm.common import fresh, materialize, per_process

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8
H = 0.75
STEPS = 4
MIN_GROUP = 200
UNIT = 256
DIMS = ["word_length", "symbols", "capitals", "punctuation", "repetition", "digits"]
# Smallest standard deviation believed per dimension (in the units of DIMS): many
# groups have no symbol or digit at all, which would make their scatter singular,
# and the few honest texts that have some all outliers (figures in the README).
# The largest value of any dimension, alone, is beyond the cut.
FLOOR = [0.08, 0.35, 0.03, 0.15, 0.45, 0.5]
D = len(DIMS)
# Word statistics of honest texts have longer tails than a normal law: squared
# distances follow a t law in D = 6 dimensions with FREEDOM = 3.
FREEDOM = 3
QUANTILE = 0.999


def law_quantile(share: float) -> float:
    """The squared distance that ``share`` of the law does not exceed (its tail has a closed form at D = 6, FREEDOM = 3)."""
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        v = FREEDOM / (FREEDOM + mid)
        tail = 105 / 16 * v ** 1.5 * (2 / 3 - 4 / 5 * v + 2 / 7 * v * v)
        low, high = (mid, high) if tail > 1 - share else (low, mid)
    return high


LAW_MEDIAN = law_quantile(0.5)
CUT = law_quantile(QUANTILE)
# Median distances below are not believed: half the group are copies then.
LEAST_MEDIAN = 0.25
# Distances are counted in steps of 1/32 of a power of two.
STEP = 32
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _kinds():
    """Per code point: 1 white space, 2 symbol, 3 capital, 4 digit, 5 sentence mark, 0 other."""

    kinds = np.zeros(0x110000, np.uint8)
    kinds[[i for i in range(0x2000) if chr(i).isupper()]] = 3
    for marks, k in ((" \t\n\r\x0b\x0c", 1), ("#*$%&|<>", 2), ("0123456789", 4), (".,;:!?", 5)):
        kinds[[ord(c) for c in marks]] = k
    return kinds


def text_stats(text: str | None) -> tuple:
    """The contract's counts of one text, then its vector in 1/UNIT steps."""

    text = text or ""
    kinds = per_process("char_kinds", _kinds)
    n = np.bincount(kinds[np.frombuffer(text.encode("utf-32-le"), "<u4")], minlength=6)
    words = text.encode().split()
    n_words, chars = len(words), len(text) - int(n[1])
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    dup_lines = len(lines) - len(set(lines))
    repeated = repeat_words(words)
    if not n_words:
        return 0, 0, int(n[2]), dup_lines, 0, [0] * D
    vector = [np.log2(chars / n_words), np.log2(1 + 200 * n[2] / chars), np.arcsin(np.sqrt(n[3] / chars)),
              np.log2(1 + 100 * n[5] / chars), np.log2(1 + 100 * repeated / n_words), np.log2(1 + 200 * n[4] / chars)]
    return n_words, chars, int(n[2]), dup_lines, repeated, [round(float(v) * UNIT) for v in vector]


def repeat_words(words: list[bytes], size: int = WINDOW_WORDS) -> int:
    """Words inside windows of ``size`` words that occur twice or more."""

    n = len(words) - size + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    with np.errstate(over="ignore"):
        w = np.zeros(n, np.uint64)
        for k in range(size):
            w = w * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
            w ^= w >> np.uint64(29)
    order = np.argsort(w, kind="stable")
    same = w[order][1:] == w[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(again), 1)
    np.add.at(edge, np.flatnonzero(again) + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def with_stats(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` and the struct ``out`` of the counts and the vector ``x``."""
    schema = f"struct<{COUNTS.replace(' long', ':long')},x:array<int>>"

    @F.pandas_udf(schema)
    def stats(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:

        names = [c.split()[0] for c in COUNTS.split(", ")] + ["x"]
        for s in batches:
            yield pd.DataFrame([text_stats(t) for t in s.astype(object).where(s.notna(), None)], columns=names)

    # Not to be copied into the filters above it: each copy would read every text in a Python worker of its own.
    return df.withColumn(out, stats.asNondeterministic()(F.col(text)))


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def _share_step(df: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """Per group the smallest value that at least ``share`` of its rows do not exceed, from counts per value."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy(*keys).orderBy(value)
    every = Window.partitionBy(*keys)
    return (counts.withColumn("upto", F.sum("c").over(upto)).withColumn("total", F.sum("c").over(every))
                  .where(F.col("upto") >= F.ceil(F.col("total") * share))
                  .groupBy(*keys).agg(F.min(value).alias("edge")))


def _distance(x: Column, mean: Column, inv: Column) -> Column:
    """Squared Mahalanobis distance; ``inv`` holds the upper triangle, off-diagonal terms doubled."""
    d = [x[i] - mean[i] for i in range(D)]
    terms = [inv[k] * d[i] * d[j] for k, (i, j) in enumerate((i, j) for i in range(D) for j in range(i, D))]
    return sum(terms[1:], terms[0])


def _moments(df: DataFrame, keys: list[str], x: Column) -> DataFrame:
    """Exact sums: rows, values and products."""
    v = [x[i].cast("long") for i in range(D)]
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(a) for a in v]).alias("s1"),
        F.array(*[F.sum(v[i] * v[j]) for i in range(D) for j in range(i, D)]).alias("s2"))


def _moments_inside(measured: DataFrame, keys: list[str], share: float, margin: int = 0) -> DataFrame:
    """Moments of the rows up to ``margin`` steps beyond the one (as in ``_share_step``) that ``share`` of a
    group's rows do not exceed. Rows are read once: each distance step has its own moments, and the steps
    inside are added up."""
    per = _moments(measured, [*keys, "step"], F.col("x"))
    every = Window.partitionBy(*keys)
    per = (per.withColumn("upto", F.sum("n").over(every.orderBy("step"))).withColumn("total", F.sum("n").over(every))
              .withColumn("edge", F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * share), F.col("step"))).over(every)))
    return per.where(F.col("step") <= F.col("edge") + margin).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s1")[i]) for i in range(D)]).alias("s1"),
        F.array(*[F.sum(F.col("s2")[k]) for k in range(D * (D + 1) // 2)]).alias("s2"))


def _solve(n, s1, s2):
    """Mean, inverse scatter (upper triangle) and log-determinant of exact sums, with the floor added."""

    mean = np.array(s1, float) / n
    cov = np.zeros((D, D))
    cov[np.triu_indices(D)] = np.array(s2, float) / n - np.outer(mean, mean)[np.triu_indices(D)]
    cov = np.triu(cov) + np.triu(cov, 1).T + np.diag((np.array(FLOOR) * UNIT) ** 2)
    inv = np.linalg.inv(cov)
    upper = (2 * inv - np.diag(np.diag(inv)))[np.triu_indices(D)]
    return mean.tolist(), upper.tolist(), float(np.linalg.slogdet(cov)[1])


def _estimates(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Moments to estimates, one small row per group."""
    schema = ", ".join(f"{c} {t}" for c, t in moments.dtypes if c in keys)

    def solve(batches):
        for pdf in batches:
            got = [_solve(*r) for r in zip(pdf["n"], pdf["s1"], pdf["s2"])]
            yield pdf[keys].assign(n=pdf["n"], mean=[g[0] for g in got], inv=[g[1] for g in got],
                                   logdet=[g[2] for g in got])

    return moments.mapInPandas(solve, f"{schema}, n long, mean array<double>, inv array<double>, logdet double")


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def _joined(rows: DataFrame, params: DataFrame, keys: list[str]) -> DataFrame:
    p = params.select(*[F.col(k).alias(f"p_{k}") for k in keys], *[c for c in params.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"p_{k}")) for k in keys]
    return rows.join(p, cond).drop(*[f"p_{k}" for k in keys])


def _starts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Two deterministic starts per group (column ``start``)."""
    long = rows.select(*keys, F.posexplode("x").alias("dim", "v"))
    med = _share_step(long, [*keys, "dim"], "v", 0.5)
    dev = _joined(long, med, [*keys, "dim"]).withColumn("v", F.abs(F.col("v") - F.col("edge"))).drop("edge")
    mad = _share_step(dev, [*keys, "dim"], "v", 0.5).withColumnRenamed("edge", "mad")
    both = materialize(_joined(med, mad, [*keys, "dim"]), "medians")
    wide = both.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("dim", "edge", "mad"))).alias("m"))
    var = [(F.col("m")[i]["mad"] * 1.4826) ** 2 + (FLOOR[i] * UNIT) ** 2 for i in range(D)]
    zero = F.lit(0.0)
    centre = F.transform("m", lambda m: m["edge"].cast("double"))
    diagonal = F.array(*[1 / var[i] if i == j else zero for i in range(D) for j in range(i, D)])
    first = wide.select(*keys, F.lit(0).alias("start"), centre.alias("mean"), diagonal.alias("inv"))
    # Spatial signs: every vector, scaled by MAD, pulled to length one (in 1/UNIT steps again).
    scaled = _joined(rows, first.select(*keys, "mean", "inv"), keys)
    where = {i: k for k, (i, j) in enumerate((i, j) for i in range(D) for j in range(i, D)) if i == j}
    norm = F.sqrt(_distance(F.col("x"), F.col("mean"), F.col("inv")) + 1e-9)
    # Back in the vector's own units, so that the scatter is one of vectors.
    sign = F.array(*[F.round((F.col("x")[i] - F.col("mean")[i]) / norm).cast("int") for i in range(D)])
    signs = _estimates(_moments(scaled.select(*keys, sign.alias("x")), keys, F.col("x")), keys)
    second = _joined(signs.select(*keys, "inv"), first.select(*keys, "mean"), keys).select(
        *keys, F.lit(1).alias("start"), "mean", "inv")
    assert len(where) == D
    return first.unionByName(second)


def scatter(rows: DataFrame, keys: list[str], h: float = H, steps: int = STEPS) -> DataFrame:
    """Minimum covariance determinant per group of ``rows`` (columns ``keys``
    and ``x``): ``keys, n, mean, inv`` with distances scaled to the law's median."""
    keyed = [*keys, "start"]
    params = materialize(_starts(rows, keys), "starts")
    steps_of = F.floor(F.log2(F.col("d2") + 1) * STEP).cast("int")

    def measured(p, pk):
        d = _joined(rows, p.select(*pk, "mean", "inv"), keys if pk == keys else keys)
        return d.withColumn("d2", _distance(F.col("x"), F.col("mean"), F.col("inv"))).drop("mean", "inv")

    for _ in range(steps):
        d = measured(params, keyed).withColumn("step", steps_of)
        params = materialize(_estimates(_moments_inside(d, keyed, h), keyed), "concentration")
    best = params.groupBy(*keys).agg(F.min_by(F.struct("mean", "inv"), F.struct("logdet", "start")).alias("best"))
    best = best.select(*keys, "best.mean", "best.inv")
    # Reweighting: all vectors within three times the median distance.
    d = measured(best, keys).withColumn("step", steps_of)
    final = materialize(_estimates(_moments_inside(d, keys, 0.5, 2 * STEP), keys), "reweighted")
    d = measured(final, keys).withColumn("step", steps_of)
    scale = _share_step(d, keys, "step", 0.5)
    ratio = LAW_MEDIAN / F.greatest(F.pow(F.lit(2.0), (F.col("edge") + 1) / STEP) - 1, F.lit(LEAST_MEDIAN))
    return _joined(final, scale, keys).select(
        *keys, "n", "mean", F.transform("inv", lambda v: v * ratio).alias("inv"))


def group_estimates(vectors: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Estimates per language and source, per language and over all, from
    ``lang, source, x``; each (lang, source) gets the finest level with
    ``min_group`` documents: ``lang, source, mean, inv``."""
    levels = vectors.select(
        F.explode(F.array(F.struct(F.lit(2).alias("level"), F.col("lang").alias("a"), F.col("source").alias("b")),
                          F.struct(F.lit(1).alias("level"), F.col("lang").alias("a"), F.lit(None).cast("string").alias("b")),
                          F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("a"),
                                   F.lit(None).cast("string").alias("b")))).alias("g"), "x")
    est = materialize(scatter(levels.select("g.*", "x"), ["level", "a", "b"]), "estimates")
    groups = vectors.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_group"))
    by_lang = vectors.groupBy("lang").agg(F.count(F.lit(1)).alias("n_lang")).withColumnRenamed("lang", "l")
    groups = groups.join(by_lang, F.col("lang").eqNullSafe(F.col("l")), "left").drop("l")
    level = F.when(F.col("n_group") >= min_group, 2).when(F.col("n_lang") >= min_group, 1).otherwise(0)
    groups = groups.select("lang", "source", level.alias("level"),
                           F.when(level >= 1, F.col("lang")).alias("a"), F.when(level == 2, F.col("source")).alias("b"))
    return _joined(groups, est, ["level", "a", "b"]).select("lang", "source", "mean", "inv")


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
           cut: float = CUT) -> tuple[DataFrame, str]:
    """``docs`` with one struct column (its name is returned): the counts,
    ``base_failed``, ``distance`` (null if the base rules failed) and ``kept``."""
    s, p = fresh(docs, "stats"), fresh(docs, "group")
    stats = with_stats(docs, text, s)
    vectors = materialize(stats.select(F.col(lang).cast("string").alias("lang"),
                                       F.col(source).cast("string").alias("source"), s)
                          .where(~base_failed(F.col(s))).select("lang", "source", F.col(f"{s}.x").alias("x")), "vectors")
    return _judge(stats, group_estimates(vectors), s, p, lang, source, cut), s


def _judge(stats, est, s, p, lang, source, cut):
    est = materialize(est.select(F.struct("lang", "source", "mean", "inv").alias(p)), "groups")
    joined = stats.join(est, F.col(lang).cast("string").eqNullSafe(F.col(f"{p}.lang"))
                        & F.col(source).cast("string").eqNullSafe(F.col(f"{p}.source")), "left")
    failed = base_failed(F.col(s))
    d2 = F.when(~failed, _distance(F.col(f"{s}.x"), F.col(f"{p}.mean"), F.col(f"{p}.inv")))
    verdict = ~failed & ~F.coalesce(d2 > cut, F.lit(False))
    counts = [c.split()[0] for c in COUNTS.split(", ")]
    return joined.withColumn(s, F.struct(*[F.col(f"{s}.{c}").alias(c) for c in counts], F.col(f"{s}.x").alias("x"),
                                         failed.alias("base_failed"), d2.alias("distance"),
                                         verdict.alias("kept"))).drop(p)


def quality_filter(docs: DataFrame, **kw) -> DataFrame:
    """The documents that pass, with their own columns."""
    out, s = judged(docs, **kw)
    return out.where(F.col(f"{s}.kept")).drop(s)


def quality_report(docs: DataFrame, doc_id: str = "doc_id", **kw) -> DataFrame:
    out, s = judged(docs, **kw)
    counts = [c.split()[0] for c in COUNTS.split(", ")]
    return out.select(F.col(doc_id).alias("doc_id"), *[F.col(f"{s}.{c}") for c in counts],
                      F.col(f"{s}.base_failed"), F.col(f"{s}.kept"), F.col(f"{s}.distance"))
