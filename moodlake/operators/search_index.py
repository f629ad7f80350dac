"""L1: catalogue search over a stored index of posting lists.

``build_index`` stores every catalogue's cards and, for each name, its grams
of one, two and three characters: ``kind, gram, id, name``, partitioned by a
bucket of the gram, with the length of each gram's list. ``search_index`` reads only the
buckets of the term's grams: the rarest lists are intersected (a partial
aggregate), the names in the postings are verified against the whole term and
ranked as ``search.relevance`` ranks them, and only the capped winners fetch
their image and artist, from the card buckets that hold them.

A term of any length is exact: shorter than three characters it is a gram
itself, longer it holds all its grams, and the verification decides.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodlake.operators.search import DEFAULT_CAPS, relevance

GRAM = 3
RAREST = 3          # posting lists intersected per term; more would only be read to verify what the name verifies
BUCKETS = 16        # raise with the catalogues: a search reads whole buckets
TASK_NAMES = 100_000    # names whose grams one task sorts and writes
CARD = ["kind", "id", "name", "image", "artist"]


def _grams(name: Column) -> Column:
    n = F.lower(name)

    def sized(k: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.length(n) - k + 1), lambda i: F.substr(n, i, F.lit(k)))
        return F.when(F.length(n) >= k, every).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[sized(k) for k in range(1, GRAM + 1)]))


def _bucket(c, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def build_index(catalogs: dict[str, DataFrame], path: str, buckets: int = BUCKETS) -> str:
    """Store cards (``id, name, image[, artist]`` per kind; ids as text) and postings below ``path``."""
    cards = None
    for kind, df in catalogs.items():
        artist = F.col("artist") if "artist" in df.columns else F.lit(None).cast("string")
        one = df.select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id"), "name", "image", artist.alias("artist"))
        cards = one if cards is None else cards.unionByName(one)
    spark = cards.sparkSession
    (cards.where("name is not null").withColumn("bucket", _bucket(F.col("id"), buckets))
          .hint("rebalance", F.col("kind"), F.col("bucket"))
          .write.mode("overwrite").partitionBy("kind", "bucket").parquet(os.path.join(path, "cards")))
    stored = read_cards(spark, path)
    (postings(stored, stored.count() // TASK_NAMES + 1, buckets)
             .write.mode("overwrite").partitionBy("bucket").parquet(os.path.join(path, "postings"), compression="zstd"))
    (read_postings(spark, path).groupBy("bucket", "kind", "gram").agg(F.count(F.lit(1)).alias("n"))
        .hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(os.path.join(path, "lengths")))
    return path


def postings(cards: DataFrame, tasks: int, buckets: int = BUCKETS) -> DataFrame:
    """``kind, id, name, gram, bucket``, a row per gram of every name. The names are dealt, not
    their grams: each task sorts those of its names and writes them by bucket."""
    names = cards.select("kind", "id", "name").repartition(tasks, "kind", "id", "name").dropDuplicates()
    rows = names.select("kind", "id", "name", F.explode(_grams(F.col("name"))).alias("gram"))
    return rows.withColumn("bucket", _bucket(F.col("gram"), buckets)).sortWithinPartitions("bucket", "gram", "kind", "name")


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string, name string, image string, artist string, kind string, bucket int").parquet(
        os.path.join(path, "cards"))


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("kind string, id string, name string, gram string, bucket int").parquet(
        os.path.join(path, "postings"))


def term_grams(term: str) -> list[str]:
    """The grams that every name holding the term holds, longest kind only."""
    t = term.lower()
    k = min(GRAM, len(t))
    return sorted({t[i:i + k] for i in range(len(t) - k + 1)})


def _in_buckets(spark: SparkSession, grams: list[str], buckets: int) -> Column:
    """Filter on the grams and, as literals, on their buckets: partitions are pruned when the plan is made."""
    values = ", ".join("(" + repr(g) + ")" for g in grams)
    found = spark.sql(f"SELECT DISTINCT pmod(xxhash64(g), {buckets}) AS b FROM VALUES {values} AS t(g)").collect()
    return F.col("bucket").isin([int(r.b) for r in found]) & F.col("gram").isin(grams)


def candidates(spark: SparkSession, path: str, term: str, kinds: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``kind, id, name`` in all of the term's rarest posting lists."""
    grams = term_grams(term)
    wanted = _in_buckets(spark, grams, buckets)
    lengths = spark.read.schema("kind string, gram string, n long, bucket int").parquet(os.path.join(path, "lengths"))
    sizes = {g: 0 for g in grams}
    for r in lengths.where(wanted & F.col("kind").isin(kinds)).groupBy("gram").agg(F.sum("n").alias("n")).collect():
        sizes[r.gram] = r.n     # one row per gram of the term
    rarest = sorted(grams, key=lambda g: (sizes[g], g))[:RAREST]
    lists = read_postings(spark, path).where(_in_buckets(spark, rarest, buckets) & F.col("kind").isin(kinds))
    if len(rarest) == 1:
        return lists.select("kind", "id", "name")
    both = lists.groupBy("kind", "id", "name").agg(F.count(F.lit(1)).alias("held"))
    return both.where(F.col("held") == len(rarest)).drop("held")


def search_index(spark: SparkSession, path: str, term: str, caps: dict[str, int] | None = None,
                 buckets: int = BUCKETS) -> DataFrame:
    """L1: ``kind, id, name, image, artist, relevance, rank``, each kind capped. An empty term finds nothing."""
    caps = caps or DEFAULT_CAPS
    if not term:
        return read_cards(spark, path).where("false").select(*CARD, F.lit(0).alias("relevance"), F.lit(0).cast("long").alias("rank"))
    hits = candidates(spark, path, term, list(caps), buckets)
    hits = hits.withColumn("relevance", relevance(F.col("name"), term)).where("relevance is not null")
    best = Window.partitionBy("kind").orderBy("relevance", "name", "id")
    cap = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {n}" for k, n in caps.items()) + " END")
    top = hits.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= max(caps.values()))
    won = top.where(F.col("rank") <= cap).collect()          # at most the sum of the caps
    if not won:
        return read_cards(spark, path).where("false").select(*CARD, F.lit(0).alias("relevance"), F.lit(0).cast("long").alias("rank"))
    won = spark.createDataFrame(won, top.schema).withColumn("bucket", _bucket(F.col("id"), buckets))
    at = [(r.kind, r.bucket) for r in won.select("kind", "bucket").distinct().collect()]
    here = F.lit(False)
    for kind, bucket in at:
        here = here | ((F.col("kind") == kind) & (F.col("bucket") == bucket))
    held = read_cards(spark, path).where(here).dropDuplicates(["kind", "id", "name"])
    return won.drop("bucket").join(held.select("kind", "id", "name", "image", "artist"), ["kind", "id", "name"]) \
              .select(*CARD, "relevance", "rank")
