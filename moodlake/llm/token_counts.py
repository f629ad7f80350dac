"""Exact length histogram.

Documents are aggregated by encoded length; suffix sums over the histogram
answer, for every context limit L, the documents and tokens at or above L and
the total when every document is cut to L tokens.

Defined results: a null or empty text has length 0 (plus ``end_tokens``);
repeated rows each count; an empty table gives an empty histogram; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.llm.common import materialize
from moodlake.llm.tokens import DEFAULT_TOKENIZER, encoder

# Lengths per block: suffix sums run inside a block and over the few block totals.
BLOCK = 256


def lengths(docs: DataFrame, text: str = "text", tokenizer: str = DEFAULT_TOKENIZER,
            end_tokens: int = 1) -> DataFrame:
    """One row per document: ``length``, its number of token ids."""
    def count(batches: Iterator) -> Iterator:
        enc = encoder(tokenizer)
        for pdf in batches:
            ids = enc.encode(pdf.iloc[:, 0].fillna("").tolist())
            yield pdf.iloc[:, :0].assign(length=[len(b) // 4 + end_tokens for b in ids])

    return docs.select(text).mapInPandas(count, "length long")


def length_histogram(lens: DataFrame) -> DataFrame:
    """From rows of ``length``: per distinct length its documents
    (``n_docs``), those up to it (``docs_upto``), the documents and tokens of
    this length or more (``docs_atleast``, ``tokens_atleast``), all documents
    and tokens (``docs_total``, ``tokens_total``) and the total when cut to
    this length (``tokens_cut``)."""
    # Written once: it is read twice below, and its input tokenises whole texts.
    hist = materialize(lens.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))
                           .withColumn("block", F.floor(F.col("length") / BLOCK)), "histogram")
    # One row per block of lengths: as many as the longest text has blocks.
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("b_docs"),
                                       F.sum(F.col("n_docs") * F.col("length")).alias("b_tokens"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("b_docs").over(after), zero).alias("after_docs"),
        F.coalesce(F.sum("b_tokens").over(after), zero).alias("after_tokens"),
        F.sum("b_docs").over(every).alias("docs_total"),
        F.sum("b_tokens").over(every).alias("tokens_total"))
    here = Window.partitionBy("block").orderBy(F.col("length").desc())
    out = hist.join(blocks, "block").select(
        "length", "n_docs", "docs_total", "tokens_total",
        (F.sum("n_docs").over(here) + F.col("after_docs")).alias("docs_atleast"),
        (F.sum(F.col("n_docs") * F.col("length")).over(here) + F.col("after_tokens")).alias("tokens_atleast"))
    return out.select(
        "length", "n_docs",
        (F.col("docs_total") - F.col("docs_atleast") + F.col("n_docs")).alias("docs_upto"),
        "docs_atleast", "tokens_atleast", "docs_total", "tokens_total",
        _cut(F.col("length"), F.col("length")).alias("tokens_cut"))


def _cut(limit: Column, length: Column) -> Column:
    """Total with every document cut to ``limit``, from the histogram row of
    the shortest length that is not below it."""
    return F.col("tokens_total") - F.col("tokens_atleast") + limit * F.col("docs_atleast")


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """Per context limit: documents that fit, documents cut, and the total of
    tokens kept, read off the histogram (the next length up holds the sums)."""
    lim = hist.sparkSession.createDataFrame([(int(x),) for x in limits], "context_limit long")
    edge = (hist.join(F.broadcast(lim), F.col("length") > F.col("context_limit"))
                .groupBy("context_limit").agg(F.min_by(F.struct("docs_atleast", "tokens_atleast"), "length").alias("e")))
    totals = hist.agg(F.max("docs_total").alias("docs_total"), F.max("tokens_total").alias("tokens_total"))
    zero = F.lit(0).cast("long")
    cut, above = F.coalesce(F.col("e.docs_atleast"), zero), F.coalesce(F.col("e.tokens_atleast"), zero)
    total, tokens = F.coalesce("docs_total", zero), F.coalesce("tokens_total", zero)
    return (lim.join(edge, "context_limit", "left").join(F.broadcast(totals)).select(
        "context_limit", (total - cut).alias("docs_fit"), cut.alias("docs_cut"),
        (tokens - above + F.col("context_limit") * cut).alias("tokens_kept")))


def quantiles(hist: DataFrame, probs: list[float]) -> DataFrame:
    """Per probability p the smallest length whose share of documents up to it is at least p."""
    p = hist.sparkSession.createDataFrame([(float(x),) for x in probs], "prob double")
    return (hist.join(F.broadcast(p), F.col("docs_upto") >= F.col("prob") * F.col("docs_total"))
                .groupBy("prob").agg(F.min("length").alias("length")))
