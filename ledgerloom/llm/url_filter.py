"""URL lists behind a blocked Bloom filter, and host and path rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .storage import ascii_lower, keep

#: The filter has so many blocks of 256 bits whatever the list's length: 0.5 MB, which bounds its broadcast.
BLOCKS = 16384
BITS = 6
#: Query parameters that do not name a page.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, lower-cased, and the path after it; empty without ``://``."""
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substr(url, place + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), "^[^?#]*", 0)
    return ascii_lower(host), path


def canonical(url: Column) -> Column:
    """Host without www. and m., path without trailing slash, query without tracking and sorted; no scheme or fragment."""
    host, path = host_and_path(url)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    named = F.array_sort(F.filter(F.split(query, "&"), lambda p: ~p.rlike(TRACKING) & (p != "")))
    bare = F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, "/+$", ""))
    return F.when(F.size(named) > 0, F.concat(bare, F.lit("?"), F.array_join(named, "&"))).otherwise(bare)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; rules are (verdict, host, path), few enough to spell out."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a key and its bits as four words."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    bits = F.xxhash64(F.lit("bits"), key)
    words = [F.lit(0).cast("long") for _ in range(4)]
    for i in range(BITS):
        spot = F.shiftrightunsigned(bits, 8 * i).bitwiseAND(F.lit(255))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(F.lit(63)).cast("int"))
        word = F.shiftright(spot, 6)
        words = [w.bitwiseOR(F.when(word == n, one).otherwise(F.lit(0).cast("long"))) for n, w in enumerate(words)]
    return block, words


def blocked_filter(keys: DataFrame, column: str, blocks: int = BLOCKS) -> DataFrame:
    """At most ``blocks`` rows: block and its words w0 to w3."""
    block, words = _place(F.col(column), blocks)
    return keys.select(block.alias("block"), *[w.alias(f"w{n}") for n, w in enumerate(words)]).groupBy("block").agg(
        *[F.bit_or(f"w{n}").alias(f"w{n}") for n in range(4)]
    )


def judged_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    blocks: int = BLOCKS,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    ``listed`` has a column ``canonical`` of different canonical URLs to block.  A rule's verdict goes before the
    list's.  A null URL and one without ``://`` have an empty host and path, fit no rule, are on no
    list and are allowed.  Rows that repeat an id are judged each.  Other columns are not read.
    """
    url = F.col(url_col)
    host, path = host_and_path(url)
    host, path = F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))
    rows = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"), canonical(url).alias("canonical"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("ruled", verdict)
    block, words = _place(F.col("canonical"), blocks)
    bits = blocked_filter(listed, "canonical", blocks).select(F.col("block").alias("_block"), *[F.col(f"w{n}").alias(f"_w{n}") for n in range(4)])
    tested = rows.withColumn("_block", F.when(F.col("host") != "", block)).join(F.broadcast(bits), "_block", "left")
    hit = F.lit(True)
    for n, word in enumerate(words):
        hit = hit & (F.col(f"_w{n}").bitwiseAND(word) == word)
    tested = tested.withColumn("_hit", F.coalesce(hit, F.lit(False)) & F.col("ruled").isNull()).drop("_block", *[f"_w{n}" for n in range(4)])
    sure = tested.filter(~F.col("_hit")).withColumn("verdict", F.coalesce(F.col("ruled"), F.lit("allow")))
    exact = listed.select("canonical", F.lit("block").alias("_listed"))
    possible = tested.filter("_hit").join(exact, "canonical", "left").withColumn("verdict", F.coalesce("_listed", F.lit("allow")))
    columns = [F.col("_id").alias(id_col), "host", "path", "rule", "verdict"]
    return sure.select(*columns).unionByName(possible.select(*columns))


def claimed_twice(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Canonical URLs that more than one page id claims."""
    rows = pages.select(F.col(id_col).alias("id"), canonical(F.col(url_col)).alias("canonical"))
    named = rows.filter((F.col("canonical") != "") & F.contains(F.col("canonical"), F.lit(".")))
    ends = named.groupBy("canonical").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    return keep(ends.filter("a < b").select("canonical"), "listed-urls")
