"""Language identification by multilingual mixture inference.

Training counts character trigrams per language over all labelled documents
(hashed to ``BUCKETS`` buckets, trigrams with a letter only); the result is
one probability table per language. A document is a mixture: expectation-
maximisation estimates each language's share from the trigram likelihoods,
then languages are dropped one by one, weakest first, while the loss of
log-likelihood stays below the penalty (``PENALTY`` times the logarithm of the
number of trigrams per language). The language with the largest share of the
remaining set is the prediction, its share the score.

Defined results: ``und`` with score 0 where the text is null or has no letter,
or where there was nothing to learn from; ties go to the language that sorts
first; repeated rows count each time in training and are predicted alike; null
languages are not learned from; extra columns are not read. Whole texts count,
in training and prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import materialize, per_process

BUCKETS = 1 << 15
SMOOTHING = 0.5
# Expectation-maximisation ends when no share moves by more.
TOLERANCE = 1e-3
PENALTY = 3.0
UNDEFINED = "und"


def _letters():
    """Per code point its lower-case letter, or 32 for anything else."""

    table = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def trigrams(text: str | None):
    """Bucket of each trigram with a letter in the middle, white space and
    everything else that is no letter taken as one blank."""

    if not text:
        return np.empty(0, np.int64)
    c = per_process("letters", _letters)[np.frombuffer(text.encode("utf-32-le"), "<u4")]
    blank = c == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    c = np.concatenate(([32], c[keep], [32])).astype(np.uint32)
    h = c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA77) ^ c[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    return (h[c[1:-1] != 32] % np.uint32(BUCKETS)).astype(np.int64)


def trigram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, bucket, n`` over all rows with a language: counted per task first, then summed."""
    def tally(batches: Iterator) -> Iterator:
        total = {}
        for pdf in batches:
            for name, t in zip(pdf["lang"], pdf["text"]):
                g = trigrams(t)
                if name not in total:
                    total[name] = np.zeros(BUCKETS, np.int64)
                if len(g) > BUCKETS // 8:
                    total[name] += np.bincount(g, minlength=BUCKETS)
                else:
                    np.add.at(total[name], g, 1)
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": name, "bucket": at, "n": n[at]})

    src = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null")
    return (src.mapInPandas(tally, "lang string, bucket long, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their log-free probability tables (languages x BUCKETS):
    4 * BUCKETS bytes per language, whatever the number of documents."""

    counts = materialize(trigram_counts(docs, text, lang), "trigrams")
    langs, rows = [], []
    # One row per language, of at most BUCKETS numbers; the driver reads one partition at a time.
    of_lang = counts.groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n"))
    for r in of_lang.orderBy("lang").toLocalIterator():
        row = np.full(BUCKETS, SMOOTHING)
        row[np.array(r["at"], np.int64)] += np.array(r["n"], np.int64)
        langs.append(r["lang"])
        rows.append((row / row.sum()).astype(np.float32))
    return langs, np.array(rows, np.float32).reshape(len(langs), BUCKETS)


def mixture(p, n, iterations: int | None = None, tolerance: float = TOLERANCE):
    """Expectation-maximisation of the shares, until they stand still or for
    ``iterations``: ``p`` languages x features, ``n`` counts. Shares and log-likelihood."""

    share = np.full(len(p), 1 / len(p))
    total = n.sum()
    for _ in count() if iterations is None else range(iterations):
        joint = share[:, None] * p
        mix = joint.sum(axis=0)
        new = joint @ (n / mix) / total
        if np.abs(new - share).max() < tolerance:
            share = new
            break
        share = new
    return share, float(n @ np.log(share @ p))


def predict_one(g, table):
    """Index of the language and its share, for one document's buckets."""

    at, n = np.unique(g, return_counts=True)
    p, n = table[:, at].astype(float), n.astype(float)
    chosen = np.arange(len(table))
    share, ll = mixture(p, n)
    penalty = PENALTY * np.log(n.sum() + 1)
    while len(chosen) > 1:
        weak = int(np.lexsort((-chosen, share))[0])
        rest = np.delete(chosen, weak)
        s, less = mixture(p[rest], n)
        if ll - less > penalty:
            break
        chosen, share, ll = rest, s, less
    best = int(np.argmax(share))
    return int(chosen[best]), float(min(1.0, share[best]))


def predict(docs: DataFrame, model: tuple, text: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """``keep`` columns (name to expression), ``lang_pred`` and ``score`` of every row."""
    langs, table = model
    sent = docs.sparkSession.sparkContext.broadcast(table)   # 128 KB per language

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:

        for s in batches:
            out = []
            for t in s:
                g = trigrams(t)
                if len(g) and langs:
                    i, share = predict_one(g, sent.value)
                    out.append((langs[i], share))
                else:
                    out.append((UNDEFINED, 0.0))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    cols = [c.alias(k) for k, c in (keep or {}).items()]
    return docs.select(*cols, guess(F.col(text)).alias("__g")).select(*(keep or {}), "__g.lang_pred", "__g.score")


def held_out(doc_id: Column, mod: int, fold: int) -> Column:
    """Whether a document belongs to the held-out fold (null ids do not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == fold, F.lit(False))
