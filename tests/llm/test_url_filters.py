"""URL filters against every rule tried on every url."""

import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.llm import url_filters as uf
from moodlake.llm.common import read_table
from moodlake.llm.queries import op11_url_filters

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType())])
RULES = T.StructType([T.StructField(c, T.StringType()) for c in ("host", "path", "verdict")])


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url) if url is not None else None
    host, path = (lower(m[1]), m[2]) if m else ("", "")
    best = None
    for h, p, v in rules:
        if not h or p is None or v is None:
            continue
        h = lower(h)
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0, 0, "", ""), (len(h) + len(p), len(h), h + p, v))
    return (host, path, best[2] if best else None, best[3] if best else default)


def check(spark, urls, rules, shuffle=None):
    pages = spark.createDataFrame(list(enumerate(urls)), PAGES)
    got = uf.judge(pages, spark.createDataFrame(rules, RULES))
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    assert rows == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_random_nested_rules(spark):
    rnd = random.Random(5)
    labels, steps = ["a", "b", "ab", ""], ["/", "/a", "/ab", "/a/", "/a/b", "/é", "", "/\U0010ffff"]
    rules = [(".".join(rnd.choices(labels, k=rnd.randint(1, 4))), "".join(rnd.choices(steps, k=rnd.randint(1, 4))),
              rnd.choice(["allow", "block"])) for _ in range(400)]
    urls = ["http" + rnd.choice(["://", "s://", ":/"]) + ".".join(rnd.choices(labels + ["A"], k=rnd.randint(1, 6)))
            + "".join(rnd.choices(steps, k=rnd.randint(0, 6))) + rnd.choice(["", "?q=/a", "#/b", "?x://a/a"]) for _ in range(3000)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:    # many range partitions: stacks that stay open over partition borders
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            check(spark, urls, rules)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)


def test_odd_urls_and_rules(spark):
    rules = [("ORG", "/", "allow"), ("org", "/", "block"), ("", "/", "block"), (None, "/", "block"), ("com", None, "block"),
             ("x.com", "", "block"), ("com", "/", None)]
    urls = [None, "", "://", "http://", "org/", "http://org", "http://org/", "http://.org/", "http://borg/", "HTTP://A.ORG/b?c",
            "http://x.com", "http://x.com?", "http://x.com\n/", "http://x.com./", "a://b.org/c://d.com/", "http://org?/x",
            "http://" + "a." * 20_000 + "org/" + "x" * 50_000, "http://org/", "http://u:p@x.com/", "http://x.com:80/", "http://X.com/\u00c9"]
    check(spark, urls, rules)


def test_empty_tables_and_clashing_columns(spark):
    rules = uf.fixed_rules(spark)
    assert uf.judge(spark.createDataFrame([], PAGES), rules).collect() == []
    pages = spark.createDataFrame([(1, "http://a.org/")], PAGES)
    bare = uf.judge(pages, spark.createDataFrame([], RULES)).first()
    assert (bare.host, bare.rule, bare.verdict) == ("a.org", None, "allow")
    odd = pages.select("page_id", "url", *[F.lit("odd").alias(c) for c in (
        "HOST", "rule", "key", "pid", "top", "kind", "level", "p_host", "p_cut", "best", "__host", "__cut")])
    row = uf.judge(odd.unionByName(odd), rules).collect()
    assert len(row) == 2 and row[0].host == "a.org" and row[0].rule == "org/" and row[0]["key"] == "odd"


def test_query_equals_brute_force(spark, sf_dir):
    pages = {r.page_id: r.url for r in read_table(spark, sf_dir, "pages").select("page_id", "url").collect()}
    got = op11_url_filters(spark, sf_dir).collect()
    assert len(got) == len(pages) and {r.rule for r in got} > {None, "org/"}
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(pages[r.page_id], uf.RULES)


def test_plan_is_native(spark, sf_dir):
    plan = op11_url_filters(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan and "html" not in plan
