import random

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm.heavy import join_counted
from ledgerloom.llm.queries import op11_simhash
from ledgerloom.llm.simhash import near_links, simhash_components

from .tables import Forest, frame, odd_rows, sentence, words


def fingerprint(text, k=3):
    w = words(text)
    if not w:
        return 0
    parts = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    prints = [(r[0], fingerprint(r[1])) for r in rows]
    forest = Forest({i for i, _ in prints if i is not None})
    known = [p for p in prints if p[0] is not None]
    for x, (a, s) in enumerate(known):
        for b, t in known[:x]:
            if (s ^ t).bit_count() <= 2:
                forest.join(a, b)
    return sorted(((i, f"{p:016x}", None if i is None else forest.root(i)) for i, p in prints), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [1024, 1])
def test_against_brute_force(spark, limit):
    rows = [*odd_rows(5), (None, "same text here", "en", "a"), (None, None, "en", "a"), (7000, "x", "en", "a"), (7001, "X ", "en", "a")]
    rng = random.Random(2)
    text = sentence(rng, 300).split()
    for i in range(60):  # long texts with a few changes
        part = list(text)
        for _ in range(rng.randrange(4)):
            part[rng.randrange(len(part))] = f"n{rng.randrange(5)}"
        rows.append((8000 + i, "  \t ".join(part) + "\n", "en", "a"))
    rows += [(8000, "another text with the same id", "en", "a"), (9000, "another text with  the SAME id", "en", "b")]
    found = rows_of(simhash_components(frame(spark, rows), limit=limit))
    assert found == brute(rows)
    sizes = [sum(r[2] == c for r in found) for c in {r[2] for r in found}]
    assert max(sizes) > 20


def test_texts_over_the_edges_of_a_block(spark):
    rows = [(i, t, "en", "a") for i, t in enumerate(["ab", "cd ef", None, " gh", "ij ", "", "kl mn op", "\nqr st uv wx\n", "é 中文 É"])]
    assert rows_of(simhash_components(frame(spark, rows).coalesce(1))) == brute(rows)


def close_prints(seed, n, centres, flips):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(centres)] + [0, 2**64 - 1]
    out = set(base)
    while len(out) < n:
        p = rng.choice(base)
        for _ in range(rng.randrange(flips)):
            p ^= 1 << rng.randrange(64)
        out.add(p)
    return sorted(out)


@pytest.mark.parametrize("seed,flips,limit", [(1, 6, 1024), (2, 8, 1024), (3, 6, 4), (4, 8, 0), (5, 3, 2)])
def test_all_links_of_distance_two_are_kept(spark, seed, flips, limit):
    prints = close_prints(seed, 700, 12, flips)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    df = spark.createDataFrame([(signed(p), i) for i, p in enumerate(prints)], "fp long, node long")
    found, want = Forest(range(len(prints))), Forest(range(len(prints)))
    for r in near_links(df, limit).collect():
        assert (prints[r.a] ^ prints[r.b]).bit_count() >= 1
        found.join(r.a, r.b)
    for x, p in enumerate(prints):
        for y in range(x):
            if (p ^ prints[y]).bit_count() <= 2:
                want.join(x, y)
    assert [found.root(i) for i in range(len(prints))] == [want.root(i) for i in range(len(prints))]


def test_a_bucket_gives_a_forest_not_its_pairs(spark):
    # 400 fingerprints, many of them within two bits of each other, that share a half
    prints = sorted({(1 << a) | (1 << b) for a in range(29) for b in range(a)})[:400]
    df = spark.createDataFrame([(p, i) for i, p in enumerate(prints)], "fp long, node long")
    n = near_links(df).filter("a <> b").count()
    assert 399 <= n < 400 * 80


def test_given_documents_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(op11_simhash(spark, folder)) == brute(rows)


def test_empty_table(spark):
    assert simhash_components(frame(spark, [])).count() == 0


def test_heavy_keys_are_joined_where_they_are(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    joined = join_counted(rows, groups, ["k"], "n")
    assert joined.count() == 5000 and joined.filter("k = -1").select("top").distinct().collect()[0].top == 4998
    assert joined.columns == ["k", "id", "top"]
