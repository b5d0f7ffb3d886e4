import itertools
import random

import numpy as np

from ledgerloom.llm.decontaminate import CHANGED, LEAST, MASKS, SPAN, WINDOW, contaminated
from ledgerloom.llm.queries import op4_decontaminate

from .tables import frame, plain_words, sentence


def windows_brute(docs, items):
    """{(doc, item): (n_windows, best_equal, first_word)}"""
    found = {}
    for i, text, *_ in docs:
        if i is None:
            continue
        w = plain_words(text)
        for j, item in items:
            v = plain_words(item)
            if j is None or len(v) < LEAST:
                continue
            size = min(WINDOW, len(v))
            least = WINDOW - CHANGED if size == WINDOW else size
            number = {x: n for n, x in enumerate({*v})}
            parts = np.array([[number[x] for x in v[q : q + size]] for q in range(len(v) - size + 1)])
            own = np.array([number.get(x, -1) for x in w])
            for p in range(len(w) - size + 1):
                best = int((parts == own[p : p + size]).sum(axis=1).max()) if set(own[p : p + size].tolist()) != {-1} else 0
                if best >= least:
                    n, most, first = found.get((i, j), (set(), 0, p))
                    found[i, j] = (n | {p}, max(most, best), min(first, p))
    return {k: (len(n), most, first) for k, (n, most, first) in found.items()}


def brute(docs, items):
    return set(windows_brute(docs, items))


def test_masks_hit_every_window_with_few_changes():
    for n in range(CHANGED + 1):
        for changed in itertools.combinations(range(WINDOW), n):
            assert any(
                not {at + p for p in mask} & set(changed) for mask in MASKS for at in range(WINDOW - SPAN + 1)
            )
    assert all(max(m) + 1 == SPAN for m in MASKS)


def cases():
    rng = random.Random(4)
    items = [(k, sentence(rng, rng.choice([5, 8, 12, 13, 14, 20, 40]))) for k in range(14)]
    items += [(20, "one two three four"), (21, None), (22, ""), (None, sentence(rng, 20)), (23, items[3][1]), (24, sentence(rng, 3000))]
    docs = []
    for i in range(120):
        item = rng.choice(items[:14] + items[-1:])[1].split()
        a = rng.randrange(max(1, len(item) - 12))
        part = item[a : a + rng.choice([6, 12, 13, 14, 30])]
        for _ in range(rng.randrange(4)):
            part[rng.randrange(len(part))] = "changed"
        cut = rng.choice([" ", ", ", "\n", " - "])
        docs.append((i, sentence(rng, rng.randrange(30)) + " " + cut.join(part).title() + " " + sentence(rng, rng.randrange(30)), "en", "a"))
    docs += [(200, None, "en", "a"), (201, "", "en", "a"), (202, items[5][1], "en", "a"), (202, items[6][1], "en", "a"), (None, items[5][1], "en", "a")]
    docs += [(203, sentence(rng, 20000) + " " + items[6][1], "en", "a")]
    return docs, items


def test_against_brute_force(spark):
    docs, items = cases()
    table = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, id int")
    rows = contaminated(frame(spark, docs), table).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    full = windows_brute(docs, items)
    assert got == set(full) and len(got) == len(rows) > 40
    once = {i for i in {i for i, *_ in docs} if [d[0] for d in docs].count(i) == 1}  # places of rows that repeat an id run together
    assert all(tuple(r)[2:] == full[r.doc_id, r.item_id] for r in rows if r.doc_id in once)


def test_items_that_share_passages_have_a_row_each(spark):
    rng = random.Random(8)
    shared, short = sentence(rng, 30), sentence(rng, 7)
    items = [(1, shared), (2, shared), (3, f"{shared} {sentence(rng, 20)}"), (4, f"{sentence(rng, 20)} {shared}"), (5, short), (6, short)]
    docs = [(k, f"{sentence(rng, k)} {shared} {short} {sentence(rng, 9)}", "en", "a") for k in range(4)] + [(9, sentence(rng, 50), "en", "a")]
    got = contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = windows_brute(docs, items)
    assert len(want) == len(got) == 24
    assert {(r.doc_id, r.item_id): tuple(r)[2:] for r in got} == want


def test_given_documents_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id): tuple(r)[2:] for r in op4_decontaminate(spark, folder).collect()}
    assert got == windows_brute(docs, items) and got


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    assert contaminated(frame(spark, []), some).count() == 0
    assert contaminated(frame(spark, [(1, "a b c d e f g h", "en", "a")]), items).count() == 0
