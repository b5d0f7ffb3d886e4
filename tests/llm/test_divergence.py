import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm.divergence import partial_counts, scaled, source_divergence
from ledgerloom.llm.queries import op12_source_divergence

from .tables import frame, odd_rows, sentence


def terms_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def brute(rows, least=30):
    counts, holders, langs = {}, {}, {}
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        found = terms_of(text)
        counts.setdefault((lang, source), Counter()).update(found)
        holders.setdefault(lang, Counter()).update(set(found))
        langs.setdefault(lang, set()).add(source)
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in holders[lang].items() if n >= least]
        total = sum((counts[lang, s] for s in sources), Counter())

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1000000000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q = shares(total)
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            best = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:50]
            for part, found in (("pair", sorted(pairs)), ("term", best)):
                out += [(lang, s, part, item.decode(), -value, rank + 1) for rank, (value, item) in enumerate(found)]
    return sorted(out)


def rows_of(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def many(seed, n=300):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé中Z") for _ in range(rng.choice([1, 2, 3])))
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "de", "fr", None, ""]), rng.choice(["src0", "src0", "a", "b", "ü", None, ""])
        rows.append((i, rng.choice([" ", "-", "\x00", "\n1"]).join(word() for _ in range(rng.randrange(60))), lang, source))
    rows += [(n + 1, None, "en", "only nulls"), (n + 2, "", "it", "x"), (n + 3, "1 2 3", "it", None), (n + 4, "ciao", "it", "y")]
    rows += [(n + 5, sentence(rng, 20000), "en", "src0"), (n + 6, "Zab " * 50000, "de", "a")]
    rows[20:20] = [(n + 7, "Bäz é " * 400_000, "de", "b")]  # longer than a block of work
    return rows + rows[:40] + odd_rows(2)


@pytest.mark.parametrize("least,shard_terms,cells", [(30, 50_000, 1 << 21), (3, 7, 5), (1, 40, 100)])
def test_against_brute_force(spark, least, shard_terms, cells):
    rows = many(least)
    found = source_divergence(frame(spark, rows), least_docs=least, shard_terms=shard_terms, cells=cells)
    want = brute(rows, least)
    assert rows_of(found) == want
    assert {"pair", "term"} == {r[2] for r in want} and any(r[4] == 0 for r in want)


def test_given_documents_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    assert rows_of(op12_source_divergence(spark, folder)) == brute(rows)


def test_partial_counts_are_passed_on_when_full(spark):
    rows = [(r[1] or "", r[2] or "", r[3] or "") for r in many(4, 100)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    want = Counter((lang, source, t) for text, lang, source in rows for t in terms_of(text))
    for held in (10, 1 << 19):
        found = Counter()
        for r in partial_counts(docs, held).collect():
            found[r.lang, r.source, r.term] += r.n
        assert found == want


def test_shares_are_exact_for_large_counts():
    rng = random.Random(3)
    totals = [rng.randrange(1, 9 * 10**15) for _ in range(2000)]
    counts = [rng.randrange(0, t + 1) for t in totals]
    found = scaled(np.array(counts), np.array(totals))
    assert found.tolist() == [1 + 10**9 * c // t for c, t in zip(counts, totals)]


def test_empty_table(spark):
    assert source_divergence(frame(spark, [])).count() == 0
