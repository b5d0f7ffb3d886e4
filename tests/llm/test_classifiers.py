"""Toxicity and language."""

import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import language_id, toxicity
from ledgerloom.llm.hashing import blocks, text_bytes
from ledgerloom.llm.queries import op9_toxicity, op10_language_id, vocabulary

from .tables import frame, odd_rows, sentence

VOCABULARY = vocabulary("byte_bpe_multi_50k.tiktoken")


def fold(i, parts):
    return zlib.crc32(("" if i is None else str(i)).encode()) % parts


# ---------------------------------------------------------------- toxicity


def words_with(rng, n, bad=()):
    own = sentence(rng, n).split()
    for word in bad:
        own[rng.randrange(n)] = word
    return " ".join(own)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(3)
    bad = ["despicable", "worthless", "disgusting"]
    texts = [words_with(rng, rng.choice([20, 60, 200]), rng.sample(bad, rng.randint(1, 2))) for _ in range(150)]
    clean = [words_with(rng, rng.choice([20, 60, 200])) for _ in range(250)]
    return toxicity.train(texts + clean, np.array([1] * 150 + [0] * 250))


def scores(model, texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    bags = toxicity.Bags()
    return np.concatenate([model.scores(bags, data, offsets[a : b + 1]) for a, b in blocks(offsets, 1000)])


def test_unseen_spellings_score_like_the_word(model):
    rng = random.Random(9)
    clean = [words_with(rng, 60) for _ in range(100)]
    assert (scores(model, clean) < 0.3).mean() > 0.97
    for word in ("worthless", "worthlesss", "WORTHLESS", "disgustingg", "despicables"):
        assert (scores(model, [words_with(rng, 60, [word]) for _ in range(30)]) >= 0.3).mean() > 0.8, word


def test_one_bad_word_in_a_long_text_counts(model):
    rng = random.Random(5)
    assert scores(model, [words_with(rng, 5000, ["worthless", "disgusting"])])[0] >= 0.3


def test_score_does_not_depend_on_the_neighbours(model):
    rng = random.Random(5)
    texts = [words_with(rng, rng.randint(1, 90), ["worthless"] * rng.randint(0, 1)) for _ in range(40)] + ["", None, "word", "word word word", "a\nb"]
    together = scores(model, texts)
    assert np.allclose(together, [scores(model, [t])[0] for t in texts])
    assert together[40] == together[41] == 0 and (together >= 0).all() and (together <= 1).all()


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op9_toxicity(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hits = sum(p and y for p, y in held)
    assert hits / sum(y for _, y in held) > 0.9 and hits / sum(p for p, _ in held) > 0.85


def test_odd_rows_and_labels(spark):
    rows = [*odd_rows(2), (None, "x", None, None)]
    table = spark.createDataFrame([(r[0], 1, i % 2, 7) for i, r in enumerate(rows)] + [(None, 1, None, 1), (10**9, 0, 1, 1)], "doc_id long, quality int, toxic int, id int")
    found = toxicity.toxicity(frame(spark, rows), table).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
    assert all(0 <= r.score <= 1 for r in found)


def test_no_labels_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.toxicity(frame(spark, odd_rows()), none).collect()} == {0}
    assert toxicity.toxicity(frame(spark, []), none).count() == 0


# ---------------------------------------------------------------- language


def test_forward_sums_all_segmentations():
    rng = random.Random(1)
    letters = [bytes([b]) for b in range(256)]
    pieces = letters + [b"ab", b"abc", b"bc", b"ca", b"aaaa"]
    look = language_id.Pieces(pieces)
    chance = np.array([[rng.random(), rng.random()] for _ in pieces])
    for text in (b"a", b"abc", b"abcabcaaaa", b"caaaab", bytes([0, 97, 0]), "é".encode()):
        total = np.zeros(2)
        for cuts in itertools.product([False, True], repeat=len(text) - 1):
            ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(text)]
            parts = [text[a:b] for a, b in zip([0, *ends], ends)]
            if all(p in pieces for p in parts):
                total += np.prod([chance[pieces.index(p)] for p in parts], axis=0)
        size = np.array([len(text)])
        matrix = np.frombuffer(text, np.uint8)[None]
        alpha = language_id.forward(look.cells(matrix, size), 1, len(text), chance)
        assert np.allclose(alpha[len(text), 0], total)


def test_learning_raises_the_likelihood():
    look = language_id.Pieces(language_id.read_pieces(VOCABULARY))
    text = "the house and the garden of the old mill near the river " * 5
    chance = language_id.learn([text], look)
    assert math.isclose(chance.sum(), 1, rel_tol=1e-9) and (chance > 0).all()
    both = np.stack([chance, np.full(look.n, 1 / look.n)], axis=1)
    data, offsets = text_bytes(pa.array(["the old house of the river"]))
    logs = language_id.Scorer(look, both).texts(data, offsets)
    assert logs[0, 0] > logs[0, 1]


def test_score_is_the_same_in_any_block_and_cache():
    look = language_id.Pieces(language_id.read_pieces(VOCABULARY))
    rng = np.random.default_rng(1)
    scorer = language_id.Scorer(look, rng.dirichlet(np.ones(look.n), 3).T)
    texts = ["ein haus am see", "", "x" * 1000, "Äpfel und Öl", "ein haus", "1 2 3"] * 2
    data, offsets = text_bytes(pa.array(texts))
    whole = scorer.texts(data, offsets)
    single = np.concatenate([language_id.Scorer(look, scorer.chance).texts(*text_bytes(pa.array([t]))) for t in texts])
    assert np.allclose(whole, single) and np.allclose(scorer.texts(data, offsets), whole)


def test_held_out_language(spark):
    folder = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op10_language_id(spark, folder).collect()
    assert len(rows) == len(langs) and all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.97


def test_odd_languages(spark):
    rows = [*odd_rows(2), (None, "das ist", "de", None), (5000, "123 .,! 🙂", "en", "a")]
    found = language_id.languages(frame(spark, rows), VOCABULARY).collect()
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(str(i), []).append(t)
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
    for r in found:
        letter = [any(c.isalpha() for c in t or "") for t in texts[str(r.doc_id)]]
        if not any(letter):
            assert (r.lang_pred, r.score) == ("und", 0)
        elif all(letter):
            assert r.lang_pred in {"en", "de", "fr", "xx"} and 0 < r.score <= 1


def test_nothing_to_learn_from(spark):
    rows = [(i, f"text {i}", None, "a") for i in range(5)]
    assert {(r.lang_pred, r.score) for r in language_id.languages(frame(spark, rows), VOCABULARY).collect()} == {("und", 0.0)}
    assert language_id.languages(frame(spark, []), VOCABULARY).count() == 0
