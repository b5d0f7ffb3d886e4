import random

import numpy as np
import pytest

from ledgerloom.llm import ngram_jaccard
from ledgerloom.llm.graph import components
from ledgerloom.llm.ngram_jaccard import jaccard_components, need
from ledgerloom.llm.queries import op1_ngram_jaccard

from .tables import Forest, frame, jaccard_brute, odd_rows, sentence


def rows_of(df, id_col="doc_id"):
    return sorted(((r[id_col], r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_rows_against_all_pairs(spark, seed):
    rows = [*odd_rows(seed), (None, "a b c d e f g", "en", "src0"), (None, None, None, None)]
    got = rows_of(jaccard_components(frame(spark, rows), words=4, percent=85))
    assert got == sorted(jaccard_brute(rows, 4, 85), key=str)


def test_given_documents_against_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(op1_ngram_jaccard(spark, folder)) == sorted(jaccard_brute(rows, 4, 85), key=str)


def test_large_group_of_near_copies_in_small_pages(spark, monkeypatch):
    """Links only to some of the group: the second round has to find what the neighbours of the first did not."""
    monkeypatch.setattr(ngram_jaccard, "PAGE", 8)
    monkeypatch.setattr(ngram_jaccard, "SMALL", 3)
    monkeypatch.setattr(ngram_jaccard, "NEAR", 1)
    monkeypatch.setattr(ngram_jaccard, "BEST", 1)
    rng = random.Random(5)
    base = sentence(rng, 60).split()
    rows = []
    for i in range(90):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(60)] = f"q{rng.randrange(1000)}"
        rows.append((i, " ".join(text), "en", "src0"))
    got = rows_of(jaccard_components(frame(spark, rows), words=3, percent=80))
    assert got == sorted(jaccard_brute(rows, 3, 80), key=str)


@pytest.mark.parametrize("texts", [1, 2])
def test_pairs_of_near_copies_with_every_id_twice(spark, texts):
    """Whole rows that repeat, and ids that repeat with two texts: boxes of different pairs must not be taken as equal."""
    rng = random.Random(6)
    rows = []
    for pair in range(12):
        base = sentence(rng, 80, 10**6).split()
        for i in (2 * pair, 2 * pair + 1):
            for k in range(texts):
                text = [*base, f"end{i}", f"of{k}"]
                rows += [(i, " ".join(text), "en", "src0")] * (3 - texts)
    want = sorted(jaccard_brute(rows, 4, 85), key=str)
    assert {c for _, _, c in want} == set(range(0, 24, 2))
    assert rows_of(jaccard_components(frame(spark, rows), words=4, percent=85)) == want


def test_empty_table(spark):
    assert jaccard_components(frame(spark, [])).count() == 0


def test_need_is_the_least_overlap():
    for t in (50, 80, 85, 100):
        for a in range(1, 30):
            for b in range(1, 30):
                least = next(c for c in range(100) if 100 * c >= t * (a + b - c))
                assert need(a, b, t) == least


def test_bound_is_never_below_the_overlap():
    """Also where a group has more tokens than its byte can count."""
    rng = np.random.default_rng(1)
    for top, most in ((60, 40), (10**6, 300), (2 * 10**5, 10**5)):
        for _ in range(50 if top < 10**6 else 20):
            sets = [np.unique(rng.integers(0, top, rng.integers(1, most)).astype(np.uint64)) for _ in range(2)]
            counts = [np.minimum(np.bincount((ngram_jaccard.mix(x) >> np.uint64(56)).astype(int), minlength=256), 255).astype(np.uint8)[None] for x in sets]
            over = [ngram_jaccard.excess(np.array([len(x)]), c) for x, c in zip(sets, counts)]
            common = len(np.intersect1d(*sets))
            assert common <= ngram_jaccard.bounds(*counts, *over)[0] <= min(map(len, sets))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    forest = Forest({n for e in edges for n in e})
    for a, b in edges:
        forest.join(a, b)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert found == {n: forest.root(n) for n in linked}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
