"""URL filters by a sort-merge range join, in DataFrame functions only.

A rule ``(host, path, verdict)`` fits its host and all subdomains where the
url's path starts with the rule's. Written as ``org.example/`` + path, with
the labels of the host reversed, a rule is the interval of all keys that start
with it. Every url gives one key per suffix of its host that could be a
rule's host, with its path cut at the longest path of a rule. Keys, starts of
intervals and their ends are sorted together; a sweep over that order keeps
the stack of open rules: the running sum of starts minus ends is its height,
and the last start at that height is its top, the innermost rule.

The sweep runs inside range partitions. What is open where a partition
begins comes from two tables of one row per partition (and height), so no
task holds more than a range of keys, and a frequent host only adds pages to
the last join: the sweep sees distinct (host, cut path) pairs.

Cases: a url that is null or has no ``://`` has an empty host and path and no
rule; a host that is empty fits no rule. Of several fitting rules the one with
the most characters wins, then the one with the longer host. Rules with a null
or empty host or a null path fit nothing; hosts of rules are lower-cased;
equal rules with different verdicts block. Without a rule the verdict is
``default``. Repeated pages are judged each; an empty table gives an empty
one. Columns of ``pages`` that are named like a result are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodlake.llm.common import ascii_lower, fresh, materialize

# The rules of the registered query.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
RESULTS = ["host", "path", "rule", "verdict"]
START, POINT, END = 0, 1, 2


def fixed_rules(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in RULES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def _intervals(rules: DataFrame) -> DataFrame:
    """``key, depth, cut`` and the rule as a struct led by what decides among fitting rules."""
    r = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict")
    r = r.where("host <> '' and path is not null and verdict is not null")
    r = r.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))   # 'block' > 'allow'
    return r.select(
        F.concat(_reversed(F.col("host")), F.lit("/"), "path").cast("binary").alias("key"),
        F.size(F.split("host", r"\.", -1)).alias("depth"), F.char_length("path").alias("cut"),
        F.struct((F.char_length("host") + F.char_length("path")).alias("n"), F.char_length("host").alias("h"),
                 F.concat("host", "path").alias("rule"), F.col("verdict")).alias("top"))


def sweep(rules: DataFrame, points: DataFrame) -> DataFrame:
    """``points`` (``key`` and any columns) that lie in some interval of ``rules``
    (``key, top``), each with the ``top`` of the innermost one."""
    names = [c for c in points.columns if c != "key"]
    none = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in names]
    nothing = F.lit(None).cast(rules.schema["top"].dataType).alias("top")
    # The byte FF is in no UTF-8 text: key + FF follows every key of the interval.
    events = (rules.select("key", F.lit(START).alias("kind"), "top", *none)
              .unionByName(rules.select(F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(END).alias("kind"),
                                        nothing, *none))
              .unionByName(points.select("key", F.lit(POINT).alias("kind"), nothing, *names)))
    # Points of one key may be many: the other columns let the range split them.
    events = events.repartitionByRange("key", "kind", *names).withColumn("pid", F.spark_partition_id())
    events = materialize(events, "sweep")
    step = F.when(F.col("kind") == START, 1).when(F.col("kind") == END, -1).otherwise(0)

    # Height of the stack at every event: running sum in the partition on top of what earlier ones left open.
    net = events.groupBy("pid").agg(F.sum(step).alias("net"))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)   # a row per partition
    net = net.select("pid", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("base"))
    here = Window.partitionBy("pid").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    levels = (events.withColumn("run", F.sum(step).over(here)).where(F.col("kind") != END).join(net, "pid")
              .withColumn("level", F.col("run") + F.col("base")).where("level > 0").drop("run", "base"))

    # Top of the stack: the last start of that height, here or in an earlier partition.
    last = levels.groupBy("pid", "level").agg(F.max_by("top", F.when(F.col("kind") == START, F.col("key"))).alias("end"))
    earlier = Window.partitionBy("level").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("pid", "level", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    inside = Window.partitionBy("pid", "level").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = levels.withColumn("own", F.last("top", ignorenulls=True).over(inside)).where(F.col("kind") == POINT)
    return found.drop("top").join(carried, ["pid", "level"]).select(
        "key", *names, F.coalesce("own", "carried").alias("top"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, the deciding rule (null: none) and verdict."""
    known = _intervals(rules)
    depth, cut = known.agg(F.coalesce(F.max("depth"), F.lit(0)), F.coalesce(F.max("cut"), F.lit(0))).first()
    keep = [c for c in pages.columns if c.lower() not in RESULTS]
    k_host, k_path, k_cut = (fresh(pages, b) for b in ("host", "path", "cut"))
    split = pages.withColumn(k_host, host_of(F.col(url))).withColumn(k_path, path_of(F.col(url)))
    split = split.withColumn(k_cut, F.substring(k_path, 1, cut))
    plain = [F.col(k_host).alias("host"), F.col(k_path).alias("path")]
    if depth == 0:
        return split.select(*keep, *plain, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    pairs = split.select(F.col(k_host).alias("p_host"), F.col(k_cut).alias("p_cut")).where("p_host <> ''").distinct()
    # No rule's host has more than ``depth`` labels, so only the last ones matter.
    labels = F.reverse(F.split(F.substring_index("p_host", ".", -depth), r"\.", -1))
    keys = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(
        F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit("/"), "p_cut").cast("binary"))
    hits = sweep(known, pairs.select("p_host", "p_cut", F.explode(keys).alias("key")))
    best = materialize(hits.groupBy("p_host", "p_cut").agg(F.max("top").alias("top")), "verdicts")
    k_best = fresh(pages, "best")
    best = best.select(F.struct("p_host", "p_cut", "top").alias(k_best))
    same = (F.col(k_host) == F.col(k_best)["p_host"]) & (F.col(k_cut) == F.col(k_best)["p_cut"])
    top = F.col(k_best)["top"]
    return split.join(best, same, "left").select(
        *keep, *plain, top["rule"].alias("rule"), F.coalesce(top["verdict"], F.lit(default)).alias("verdict"))
