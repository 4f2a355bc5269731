"""URL filters against rules applied one by one, and the Bloom filter's own promises."""

import re

import pytest
from pyspark.sql import functions as F

from scorekit.llm import urlfilter
from scorekit.llm.queries import URL_RULES

from ..conftest import SF_SMALL


def by_hand(url, listed, rules):
    m = re.search("://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda x: x.group().lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    canon = re.sub("^(www|m)[.]", "", host) + re.sub("(/|[.]html)$", "", path)
    hit = url is not None and canon in listed
    best = max(fit, default=None)
    return host, path, best[2] if best else None, best[3] if best else "block" if hit else "allow", hit


def check(spark, urls, canon, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("key", F.lit("clash")).withColumn("rule", F.lit(1))
    listed = spark.createDataFrame([(c,) for c in canon], "canon string")
    got = {r.page_id: tuple(r)[1:] for r in urlfilter.judge(pages, listed, rules).collect()}
    assert got == {k: by_hand(u, set(canon), rules) for k, u in enumerate(urls)}


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "://", "http://", "http://NET", "http://net/", "http://a.net/x", "http://a.net?x", "http://anet/", "http://net./",
            "https://Example.NET/en/1", "https://www.example.net/en", "https://m.example.com/de/a?b#c", "ftp://x.org/fr/", "x://y://z.net/a",
            "http://é.org/fr/ü", "http://a.b.c.org/fr/x", "http://org/fr", "http://www.bad.com/p/", "http://m.bad.com/p.html", "http://bad.com/p", "http://BAD.com/p",
            "http://a.net/x", "http://a\nb.net/q", "http://" + "s." * 300 + "net/" + "p" * 20_000]
    check(spark, urls, ["bad.com/p", "bad.com/p", "a.net/x", None, ""], URL_RULES)


def test_overlapping_rules(spark):
    rules = [("block", "com", "/"), ("allow", "a.com", "/"), ("block", "a.com", "/xy"), ("allow", "b.a.com", "/x"), ("block", "z", "")]
    check(spark, ["h://b.a.com/xyz", "h://a.com/xyz", "h://a.com/x", "h://q.com", "h://q.com/", "h://c.b.a.com/x1", "h://z", "h://y.z/x"], [], rules)


def test_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    urls = [r.url for r in pages.select("url").collect()]
    check(spark, urls * 2, [by_hand(u, (), ())[0] + by_hand(u, (), ())[1] for u in urls[::7]], URL_RULES)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    listed = spark.createDataFrame([], "canon string")
    assert urlfilter.judge(none, listed, URL_RULES).count() == 0
    assert urlfilter.judge(none, listed, []).count() == 0
    one = spark.createDataFrame([(1, "h://a.net/")], "page_id long, url string")
    assert [r.verdict for r in urlfilter.judge(one, listed, []).collect()] == ["allow"]


def test_bloom_filter_loses_no_key(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = 5000 * 16 // 256
    bloom = urlfilter.bloom_blocks(keys, blocks)
    assert urlfilter.may_contain(keys, bloom, blocks).count() == 5000
    other = spark.range(20000).select(F.concat(F.lit("x"), "id").alias("key"))
    assert urlfilter.may_contain(other, bloom, blocks).count() < 20000 * 0.01


@pytest.mark.parametrize("size", [0])
def test_large_sides_are_not_broadcast(spark, size, monkeypatch):
    monkeypatch.setattr(urlfilter, "SEND_BYTES", size)
    check(spark, ["h://a.net/x", "h://b.org/fr/", "h://c.com/q"], ["c.com/q"], URL_RULES)
