import random
import re

import pytest
from pyspark.sql import functions as F

from barworks.llm.url_filter import filter_urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.b", "", "block"), ("a.b", "/x", "allow"), ("A.B", "/x/y/z", "block"), ("", "", "allow"), ("t.u", "/a/b", "block"), (None, "/", "block"), ("net", "/", "block")]


def parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def brute(url):
    host, path = parts(url)
    fits = {((len(h) + len(p)), len(h), h.lower() + p, v) for h, p, v in RULES if h is not None
            and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)}
    best = max(fits, default=(0, 0, None, "default"))
    return host, path, best[2], best[3]


def urls():
    source = random.Random(4)
    hosts = ["net", "x.net", "example.net", "m.EXAMPLE.net", "notexample.net", "example.com", "example.com.net", "org", "q.org", "a.b", "z.a.b", "t.u", "", ".net", "a.b.", "xnet"]
    paths = ["", "/", "/en/", "/en", "/en/a", "/de/1.html", "/fr/x?y=/en/", "/x", "/xy", "/x/y/z1", "/x/y/", "?q", "#/en/", "/a/b", "/a/bc/d", "//en/"]
    rows = [f"{source.choice(['http', 'https', ''])}://{source.choice(hosts)}{source.choice(paths)}" for _ in range(1500)]
    return rows + [None, "", "no scheme", "://", "http://net", "a\n://x.net/b\nc", "http://x.net/" + "a/" * 3000]


@pytest.mark.parametrize("blocks", [1 << 16, 1])
def test_against_brute_force(spark, blocks):
    rows = list(enumerate(urls()))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    df = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("rule", F.lit(1))
    out = filter_urls(df, rules, default="default", blocks=blocks)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert got == {k: brute(url) for k, url in rows}


def test_empty_tables(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://net/"), (1, "http://net/")], "page_id bigint, url string")
    assert filter_urls(pages.limit(0), rules).count() == 0
    assert [(r.rule, r.verdict) for r in filter_urls(pages, rules.limit(0)).collect()] == [(None, "allow")] * 2
