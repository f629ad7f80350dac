"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted in cells of source, language and topic; the cells' token
weights are raked in turn to the target share of every source, language and
topic until all three marginals agree. A document's weight is its cell's fitted
share over its share of the tokens; its probability is ``RATE`` times the
weight. Weights stay at or below 1/RATE during the fitting, so no probability
passes 1 and expected token shares of the sample are the fitted ones exactly.
Fitting ends when the marginals agree within ``TOLERANCE``, or, where the bound
lets no fit meet all targets, when a round no longer brings them nearer; the
error reached is the column ``error`` of the fitted cells. A document is drawn when a hash of its id and text, as a number
from 0 to 1, is below its probability.

Targets are tempered shares, (tokens)^``TEMPER`` normalised, unless given as
tables of value and share. Where documents have no topic column, a text's topic
is a bucket of its most frequent word of ``TOPIC_LETTERS`` letters or more.

Defined results: null source or language is a value of its own, as is the topic
of a text without such words (``none``); a null or empty text has no tokens and
takes the probability of its cell (a cell without tokens keeps weight 1);
values missing from a given target table get share 0; equal rows get equal
draws; an empty table gives no rows; extra columns pass through untouched.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.llm.common import fresh, materialize

TEMPER = 0.8
RATE = 0.5
TOPICS = 8
TOPIC_LETTERS = 6
# The marginal error that ends the fitting, and the part of it that a round (three cycles) must take off to go on.
TOLERANCE = 1e-4
PROGRESS = 0.01
DIMS = ["source", "lang", "topic"]
_LONG = re.compile(rf"[^\W\d_]{{{TOPIC_LETTERS},}}")


def topic_of(text: str) -> str:
    """Bucket of the most frequent long word (of equally frequent ones the first in order)."""
    found = Counter(_LONG.findall(text.lower()))
    if not found:
        return "none"
    most = max(found.values())
    return f"topic{crc32(min(w for w, n in found.items() if n == most).encode()) % TOPICS}"


def described(docs: DataFrame, out: str, text: str, source: str, lang: str) -> DataFrame:
    """``docs`` with the struct ``out``: source, lang, topic, tokens and the draw's number ``u``."""
    @F.pandas_udf("struct<tokens:long,topic:string>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([(len(t.encode().split()), topic_of(t)) if t else (0, "none")
                                for t in s.astype(object).where(s.notna(), None)], columns=["tokens", "topic"])

    return docs.withColumn(out, read(F.col(text))).withColumn(out, F.struct(
        F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"),
        F.col(f"{out}.topic").alias("topic"), F.col(f"{out}.tokens").alias("tokens")))


def tempered(cells: DataFrame, dim: str, temper: float = TEMPER) -> DataFrame:
    """``value, share``: token shares to the power ``temper``, normalised."""
    by = cells.groupBy(F.col(dim).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), temper).alias("p"))
    total = by.agg(F.sum("p").alias("all"))
    return by.join(F.broadcast(total)).select("value", (F.col("p") / F.col("all")).alias("share"))


def fitted(cells: DataFrame, targets: dict[str, DataFrame], rate: float = RATE,
           tolerance: float = TOLERANCE) -> DataFrame:
    """Raked cells: ``source, lang, topic, weight``, and the largest marginal
    ``error`` left; only cells with tokens."""
    sums = cells.agg(F.sum("tokens").alias("all"))
    x = cells.where("tokens > 0").join(F.broadcast(sums)).select(
        *DIMS, (F.col("tokens") / F.col("all")).alias("base"), (F.col("tokens") / F.col("all")).alias("share"))
    for d in DIMS:
        t = targets[d].select(F.col("value").alias(f"v_{d}"), F.col("share").alias(f"t_{d}"))
        x = x.join(t, F.col(d).eqNullSafe(F.col(f"v_{d}")), "left").drop(f"v_{d}").fillna(0.0, [f"t_{d}"])
    x = materialize(x, "cells")
    before = float("inf")
    while True:
        for d in DIMS * 3:
            have = F.sum("share").over(Window.partitionBy(d))
            raked = F.when(have > 0, F.col("share") * F.col(f"t_{d}") / have).otherwise(0.0)
            x = x.withColumn("share", F.least(raked, F.col("base") / rate))
        x = materialize(x, "raked")
        off = [x.groupBy(d).agg(F.abs(F.sum("share") - F.first(f"t_{d}")).alias("e")).select("e") for d in DIMS]
        worst = off[0].unionByName(off[1]).unionByName(off[2]).agg(F.max("e")).first()[0]
        if worst is None or worst < tolerance or worst > before * (1 - PROGRESS):
            break
        before = worst
    return x.select(*DIMS, (F.col("share") / F.col("base")).alias("weight"), F.lit(worst).cast("double").alias("error"))


def unit_hash(*cols: Column) -> Column:
    """A number from 0 (included) to 1 from the columns' hash."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 53)) / F.lit(float(1 << 53))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
          targets: dict[str, DataFrame] | None = None, rate: float = RATE, seed: int = 7) -> tuple[DataFrame, str]:
    """``docs`` with one struct column (its name is returned): source, lang,
    topic, tokens, weight, probability and ``drawn``."""
    out = fresh(docs, "mix")
    rows = described(docs, out, text, source, lang)
    cells = materialize(rows.select(f"{out}.*").groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")), "cells")
    targets = {**{d: tempered(cells, d) for d in DIMS}, **(targets or {})}
    probs = materialize(fitted(cells, targets, rate), "weights")
    cell = probs.select(F.struct(*[F.col(c) for c in probs.columns]).alias(f"{out}p"))
    same = F.lit(True)
    for d in DIMS:
        same = same & F.col(f"{out}.{d}").eqNullSafe(F.col(f"{out}p.{d}"))
    joined = rows.join(cell, same, "left")   # Spark broadcasts the cells or not, by their bytes
    weight = F.coalesce(F.col(f"{out}p.weight"), F.lit(1.0))
    chance = F.least(weight * rate, F.lit(1.0))
    u = unit_hash(F.lit(seed), F.col(doc_id), F.xxhash64(text))
    return joined.withColumn(out, F.struct(
        *[F.col(f"{out}.{c}").alias(c) for c in (*DIMS, "tokens")],
        weight.alias("weight"), chance.alias("probability"),
        (u < chance).alias("drawn"))).drop(f"{out}p"), out


def sample(docs: DataFrame, **kw) -> DataFrame:
    """The documents drawn, with their own columns."""
    rows, m = mixed(docs, **kw)
    return rows.where(F.col(f"{m}.drawn")).drop(m)


def report(docs: DataFrame, doc_id: str = "doc_id", **kw) -> DataFrame:
    rows, m = mixed(docs, doc_id=doc_id, **kw)
    return rows.select(F.col(doc_id).alias("doc_id"), f"{m}.*")
