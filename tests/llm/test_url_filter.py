"""URL rules against plain Python, and cascades against sets."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmill.llm import url_filter
from tripmill.llm.queries import URL_RULES
from tripmill.llm.url_filter import Rule


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.key), len(r.host), r.verdict == "block"), default=None)
    return host, path, best and best.key, best.verdict if best else "allow"


URLS = [None, "", "no scheme", "http://", "http://Example.COM/en/x", "https://example.com", "https://example.com/en", "ftp://a.www.example.com/en/?q#f"]
URLS += ["http://com/", "http://com", "http://x.net/es/a://b", "http://xnet/es/", "http://net/fr/#", "://a.net/", "http://ÉX.com/é/"]
URLS += ["http://example.net/de/", "http://.com/", "http://a..com/en/", "http://user@b.com:80/en/", "http://x.com/\n?y", "http://a.com?/en/"]


def test_rules_of_the_query(spark):
    rows = [(i, u, "x", 1) for i, u in enumerate(URLS * 2)] + [(None, "http://a.com/" + "b" * 100_000, "x", 1), (3, ".".join("a" * 3000) , "y", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule int")
    found = sorted(map(tuple, url_filter.judge(pages, URL_RULES).collect()), key=str)
    assert found == sorted([(i, *brute(u, URL_RULES)) for i, u, *_ in rows], key=str)
    assert url_filter.judge(pages.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages, []).collect()} == {"allow"}


def test_overlapping_and_conflicting_rules(spark):
    rules = [Rule("block", "a.b", "/x"), Rule("allow", "a.b", "/x"), Rule("allow", "c.a.b", ""), Rule("block", "b", "/xyz/"), Rule("allow", "b", "")]
    urls = [f"http://{h}{p}" for h in ("a.b", "c.a.b", "d.c.a.b", "b", "xa.b", "e") for p in ("", "/", "/x", "/xy", "/xyz/", "/xyz/q")]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    found = sorted(map(tuple, url_filter.judge(pages, rules).collect()))
    assert found == [(i, *brute(u, rules)) for i, u in enumerate(urls)]


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("key"), "id").alias("key"))
    for every in (3, 400, 30_000):
        listed = spark.range(0, 25_000, every).select(F.concat(F.lit("key"), "id").alias("key"))
        made = url_filter.cascade(listed, universe)
        wrong = universe.join(listed.withColumn("real", F.lit(True)), "key", "left").where(
            made.lists(F.col("key")) != F.coalesce("real", F.lit(False))
        )
        assert wrong.count() == 0
        inside = -(-20_000 // every)
        bits = sum(f.bits for f in made.filters)
        assert len(made.filters) >= 1 and bits <= 256 * len(made.filters) + inside * 40
