import re

import pytest

from daybook.llm.url_filter import filter_urls
from tests.llm.helpers import SF, have_tables

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block")]


def judge(url, rules=RULES, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in rules:
        h, p = (rule.split("/", 1)[0], rule[len(rule.split("/", 1)[0]):])
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(rule), len(h), verdict == "block")
            if best is None or rank > best[0]:
                best = rank, rule, verdict
    return host, path, best and best[1], best[2] if best else default


URLS = ["http://example.org", "http://example.org/", "HTTP://WWW.Example.ORG/es/1?q#x", "https://a.example.org/en/12",
        "x://com/fr/", "x://b.com/fr/a", "x://b.com/de", "x://b.com/de/", None, "", "no scheme/com/de/", "://org/",
        "http://notexample.org/es/", "http://org./a", "http://ex-ample.org/es/", "http://a..org/x", "http:///x", "x://y?z://org/",
        "http://münchen.org/ä\n/b", "http://example.org/en/1/2"]


def test_edges_match_brute_force(spark):
    rows = [(i if i % 5 else None, u, "k", "h") for i, u in enumerate(URLS)] + [(3, URLS[3], "k", "h")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, key string, host string")
    rules = spark.createDataFrame(RULES + [(None, "block"), ("/x", "block")], "rule string, verdict string")
    for areas in (1, 7):
        out = filter_urls(pages, rules, areas=areas).collect()
        assert sorted(map(str, [(r.id, r.host, r.path, r.rule, r.verdict) for r in out])) == \
            sorted(map(str, [(r[0], *judge(r[1])) for r in rows]))


def test_many_nested_rules_over_ranges(spark):
    import random
    rng = random.Random(5)
    labels = ["a", "b", "c-d", "com", "org", "x1"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    path = lambda: "".join(rng.choice(["/p", "/q", "/", "r"]) for _ in range(rng.randint(0, 4)))
    seen = {}
    for _ in range(150):
        p = path()
        seen[host() + (p if p[:1] == "/" else "")] = rng.choice(["allow", "block"])
    rules = [(k, v) for k, v in seen.items()]
    urls = [(i, f"http://{host()}/{path()}") for i in range(800)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    out = filter_urls(pages, spark.createDataFrame(rules, "rule string, verdict string"), areas=9, default="block")
    got = {r.id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert got == {i: judge(u, rules, "block") for i, u in urls}


def test_one_url_that_holds_most_rows_is_divided(spark):
    from pyspark.sql import functions as F
    pages = spark.range(4000).select(F.col("id").alias("page_id"), F.lit("http://a.com/de/x").alias("url"))
    out = filter_urls(pages, spark.createDataFrame(RULES, "rule string, verdict string"), areas=8)
    assert out.filter("rule = 'com/de/' AND verdict = 'block'").count() == 4000
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2000


def test_empty_tables(spark):
    rules = spark.createDataFrame([], "rule string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    assert [tuple(r) for r in filter_urls(pages, rules).collect()] == [(1, "a.org", "/x", None, "allow")]
    assert filter_urls(pages.limit(0), rules).count() == 0


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_query_matches_brute_force(spark):
    from daybook.llm.queries import op1_url_filters
    want = sorted(map(str, [(r.page_id, *judge(r.url)) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]))
    assert sorted(map(str, [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in op1_url_filters(spark, SF).collect()])) == want
