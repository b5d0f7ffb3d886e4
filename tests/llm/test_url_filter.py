import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.queries import RULES
from ledgerloom.llm.url_filter import BLOCKS, blocked_filter, canonical, claimed_twice, host_and_path, judged_urls

URLS = [
    "http://A.com/x?q=1#f", "https://www.Example.com/en/1", "https://example.com/en/1", "https://m.example.com/en/1/", "http://example.com/de/1",
    "http://www.example.com", "http://x.net/es/1", "http://net/fr/1", "http://notnet/fr/1", "http://x.net/de/1?utm_source=z", "https://www.x.net/de/1/#top",
    "http://x.org/a?b=2&a=1&ref=q", "https://x.org/a?a=1&b=2", "http://x.org/a?a=1", "no scheme", "", None, "://", "http://", "http://x.org?q", "http://x.org#f",
    "http://y.com/ü/Ä?x", "a://b://c.com/d", "http://" + "l" * 5000 + ".org/" + "p" * 50000, "http://evilnet/es/1", "http://sub.www.example.com/en/",
]
COLUMNS = "page_id long, url string, host string, path string, canonical string, rule string, block int"


def pages(spark, urls=URLS):
    rows = [(i, u) for i, u in enumerate(urls)]
    rows += [(1, urls[1]), (None, "http://x.org/a?a=1")] if urls else []
    return spark.createDataFrame([(*r, "h", "p", "c", "r", 1) for r in rows], COLUMNS)


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]


def ruled(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_hosts_and_paths(spark):
    host, path = host_and_path(F.col("url"))
    got = [(r.h or "", r.p or "") for r in pages(spark).select(host.alias("h"), path.alias("p")).collect()]
    assert got[: len(URLS)] == [parts(u) for u in URLS]


@pytest.mark.parametrize("blocks", [1, 16, BLOCKS])
def test_verdicts(spark, blocks):
    """One block of 256 bits lets nearly everything through; the join then decides."""
    table = pages(spark)
    listed = claimed_twice(table)
    names = {r.canonical for r in listed.collect()}
    assert names == {"x.net/de/1", "x.org/a?a=1&b=2", "example.com/en/1"}
    canon = {(r.page_id, r.url): r.c for r in table.select("page_id", "url", canonical(F.col("url")).alias("c")).collect()}
    want = []
    for r in table.collect():
        host, path = parts(r.url)
        rule, verdict = ruled(host, path)
        want.append((r.page_id, host, path, rule, verdict or ("block" if canon[r.page_id, r.url] in names else "allow")))
    got = [tuple(r) for r in judged_urls(table, listed, RULES, blocks=blocks).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    from ledgerloom.llm.url_filter import _place

    keys = spark.range(20000).select(F.concat(F.lit("site.org/"), F.col("id")).alias("canonical"))
    bits = blocked_filter(keys, "canonical", 1024)
    assert bits.count() <= 1024
    block, words = _place(F.col("canonical"), 1024)
    asked = spark.range(40000).select("id", F.concat(F.lit("site.org/"), F.col("id")).alias("canonical")).withColumn("block", block)
    hit = F.lit(True)
    for n, word in enumerate(words):
        hit = hit & (F.col(f"w{n}").bitwiseAND(word) == word)
    found = asked.join(bits, "block").withColumn("hit", hit).groupBy((F.col("id") < 20000).alias("real")).agg(F.avg(F.col("hit").cast("int")).alias("rate"))
    rates = {r.real: r.rate for r in found.collect()}
    assert rates[True] == 1 and rates[False] < 0.2


def test_empty_tables(spark):
    table = pages(spark, [])
    assert judged_urls(table, claimed_twice(table), RULES).count() == 0
    assert {r.verdict for r in judged_urls(pages(spark), claimed_twice(table), RULES).collect()} == {"allow", "block"}
