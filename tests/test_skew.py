"""A song with a third of all plays: the join-back of the per-play scoring
is split by AQE's skew handling, and the results stay whole."""

from pyspark.sql import functions as F

from moodlake.operators.library import circular_neighbors, list_ranges
from moodlake.operators.scoring import score_plays

SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    return old


def restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_list_neighbours_are_split(spark):
    old = skewed(spark)
    try:
        n = 30_000
        df = spark.range(n).select(F.when(F.col("id") < n // 3, F.lit("hot")).otherwise(
            (F.col("id") % 500).cast("string")).alias("list"), F.col("id").alias("pos"))
        out = circular_neighbors(df, ["list"], "pos", fields=["pos"])
        hot = out.filter("list = 'hot'").orderBy("pos").select("pos", "prev_pos", "next_pos").collect()
        assert len(hot) == n // 3 and hot[0].prev_pos == n // 3 - 1 and hot[-1].next_pos == 0
        # A (list, partition) group is the unit of every window and join here: the hot
        # list spans range partitions, and none of its groups outgrows one.
        groups = list_ranges(df, ["list"], ["pos"]).groupBy("list", "_pid").count().collect()
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert sum(g.list == "hot" for g in groups) >= parts // 3
        assert max(g["count"] for g in groups) <= 2 * n // parts
    finally:
        restore(spark, old)


def test_hot_song_join_back_is_split(spark):
    old = skewed(spark)
    try:
        n = 30_000
        plays = spark.range(n).select(
            F.col("id").alias("play_id"),
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("id"),
            F.lit("en").alias("genre"),
            F.when(F.col("id") % 3 == 0, F.lit("love love")).otherwise(F.lit("sad song")).alias("lyrics"))
        out = score_plays(plays)
        rows = out.groupBy("emotion").count().collect()
        assert sum(r["count"] for r in rows) == n                       # nothing dropped
        assert {r.emotion: r["count"] for r in rows}["joy"] == n // 3   # the hot song, whole
        plan = out._jdf.queryExecution().executedPlan().toString()
        out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in final or "skew=true" in final, final[:2000]
        assert plan  # initial plan was built
    finally:
        restore(spark, old)
