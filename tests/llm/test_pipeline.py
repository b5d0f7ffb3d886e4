"""Each stage of the pipeline against a plain version, on the given documents and on odd ones."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from ledgerloom.llm.mixing import TOKEN
from ledgerloom.llm.queries import MIX
from ledgerloom.llm.storage import table
from ledgerloom.llm.toxicity import THRESHOLD, toxicity_model, toxicity_scores

from .tables import frame, jaccard_brute, odd_rows
from .test_decontaminate import brute as contaminated_brute
from .test_mixing import mixed_brute
from .test_sharding import checked

FOLDER = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


def stages(spark, docs):
    """The rows after each stage."""
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        out.append(docs)
    return out


@pytest.mark.parametrize("which", ["given", "odd"])
def test_stages_against_plain_versions(spark, which):
    docs = table(spark, FOLDER, "documents")
    if which == "odd":
        items = [r.text for r in table(spark, FOLDER, "benchmark").limit(3).collect()]
        rows = odd_rows(7) + [(9000 + i, f"before {t} after", "en", "src0") for i, t in enumerate(items)] + [(None, "no id here", "en", "src0")]
        docs = frame(spark, rows)
    start, names = rows_of(docs), docs.columns
    clean, single, untouched, mix, shards = stages(spark, docs)
    assert all(sorted(x.columns) == sorted(names) for x in (clean, single, untouched, mix))

    # plain versions name a row by its place in the list
    texts = spark.createDataFrame([(n, r[1]) for n, r in enumerate(start)], "n long, text string")
    scores = toxicity_scores(texts, toxicity_model(docs, table(spark, FOLDER, "labels")), "n").collect()
    rejected = {r.n for r in scores if r.score >= THRESHOLD}
    assert sorted(rows_of(clean), key=str) == sorted((r for n, r in enumerate(start) if n not in rejected), key=str)

    before = sorted(rows_of(clean), key=lambda r: (r[0] is None, r[0] or 0))
    groups = jaccard_brute([(n, *r[1:]) for n, r in enumerate(before)], 5, 80)
    kept = Counter((before[n][0], before[n][1]) for n, _, component in groups if component == n)
    assert Counter((r[0], r[1]) for r in rows_of(single)) == kept
    assert not Counter(rows_of(single)) - Counter(before)
    assert len(before) > len(rows_of(single)) or which == "given"

    benchmark = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    before = rows_of(single)
    found = {n for n, _ in contaminated_brute([(n, *r[1:]) for n, r in enumerate(before)], benchmark)}
    assert found
    assert sorted(rows_of(untouched), key=str) == sorted((r for n, r in enumerate(before) if n not in found), key=str)

    assert Counter(r[0] for r in rows_of(mix)) == Counter(i for i, *_ in mixed_brute(rows_of(untouched), MIX))
    assert set(rows_of(mix)) <= set(rows_of(untouched))

    sizes = checked(rows_of(mix), shards.collect(), 8)
    assert sum(sizes) == sum(len((r[1] or "").encode()) + 1 for r in rows_of(mix))


def test_rows_that_repeat_ids(spark):
    """Every id stands for several rows: decisions are about rows."""
    passage = table(spark, FOLDER, "benchmark").first().text
    a, b, c = ("one two three four five six seven eight " + " ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    rows = [(1, a, "en", "src0"), (1, a, "en", "src0"), (1, b, "en", "src1"), (2, b, "de", "src1"), (2, f"x {passage} y", "en", "src0"), (2, c, "en", "src0")]
    docs = frame(spark, rows)
    single = rows_of(corpus_pipeline.drop_near_copies(spark, docs, FOLDER))
    assert sorted(single) == sorted([rows[0], rows[2], rows[4], rows[5]])
    untouched = rows_of(corpus_pipeline.drop_contaminated(spark, docs, FOLDER))
    assert sorted(untouched) == sorted(r for r in rows if r is not rows[4])


def test_mix_of_a_table_loaded_twice(spark):
    """The stage returns the rows that the mix takes, not all rows of their ids."""
    rows = [(i // 2, f"a b c d e{i // 2}", "en", f"src{i // 2 % 2}") for i in range(120)]
    got = rows_of(corpus_pipeline.mix_sources(spark, frame(spark, rows), FOLDER))
    want = mixed_brute(rows, MIX)
    assert Counter(r[0] for r in got) == Counter(i for i, *_ in want)


def test_mix_takes_rows_with_null_ids(spark):
    rows = [(None if i % 3 else i, f"a b c d e{i}", "en", f"src{i % 2}") for i in range(60)]
    got = rows_of(corpus_pipeline.mix_sources(spark, frame(spark, rows), FOLDER))
    taken = [i for i, *_ in mixed_brute(rows, MIX)]
    assert sorted((r[0] for r in got), key=str) == sorted(taken, key=str)
    assert 0 < taken.count(None) == sum(r[0] is None for r in got)
    assert set(got) <= set(rows)


def test_run_is_the_stages_one_after_the_other(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    want = stages(spark, table(spark, FOLDER, "documents"))[-1]
    key = lambda r: (r.doc_id, r.slot)
    assert [tuple(r) for r in sorted(got.collect(), key=key)] == [tuple(r) for r in sorted(want.collect(), key=key)]


def test_empty_documents(spark):
    assert stages(spark, frame(spark, []))[-1].count() == 0


def test_tokens_are_counted_as_words():
    assert re.findall(TOKEN, " a\tb\u00a0c\n") == ["a", "b\u00a0c"]


def test_texts_stay_where_they_are(spark, plan, monkeypatch):
    """Ids that tell the rows apart are used as they are: rows to drop take no copy and no shuffle of the texts."""
    stored = []
    made = corpus_pipeline.keep
    monkeypatch.setattr(corpus_pipeline, "keep", lambda df, name: stored.append(df.columns) or made(df, name))
    docs = table(spark, FOLDER, "documents")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_near_copies, corpus_pipeline.drop_contaminated):
            text = plan(stage(spark, docs, FOLDER))
            assert not [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "text#" in line]
            assert "SortMergeJoin" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [columns for columns in stored if "text" in columns]


def test_many_rows_to_drop_and_few(spark, monkeypatch):
    rows, row = corpus_pipeline.numbered(table(spark, FOLDER, "documents"))
    found = rows.filter(f"{row} % 3 = 0")
    few = corpus_pipeline.without(rows, found, row)
    monkeypatch.setattr(corpus_pipeline, "SENT_ROWS", 1)
    many = corpus_pipeline.without(rows, found, row)
    assert rows_of(few.orderBy("doc_id")) == rows_of(many.orderBy("doc_id")) == rows_of(rows.filter(f"{row} % 3 <> 0").orderBy("doc_id"))
