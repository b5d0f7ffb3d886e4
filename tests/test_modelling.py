import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerloom.operators import modelling, similarity, terms
from ledgerloom.operators.evaluation import binary_metrics
from ledgerloom.operators.scoring import Layer, forward
from ledgerloom.plans import learning

PEOPLE = [("m", "First", 20.0), ("f", "Third", 30.0), ("f", None, 40.0), ("f", "Third", 10.0)]


def test_one_hot_with_unknown_slot(spark):
    df = modelling.as_categories(spark.createDataFrame(PEOPLE, "sex string, class string, age double"), ["sex", "class"])
    model = modelling.fit_features(df, ["sex", "class"], ["age"])
    new = spark.createDataFrame([("f", "Second", 50.0)], "sex string, class string, age double")
    rows = model.transform(df.unionByName(new)).select(vector_to_array("features").alias("v")).collect()
    # sex: f, m, unknown; class: Third, First, nan, unknown; age
    assert rows[0].v == [0, 1, 0, 0, 1, 0, 0, 20]
    assert rows[2].v == [1, 0, 0, 0, 0, 1, 0, 40]
    assert rows[4].v == [1, 0, 0, 0, 0, 0, 1, 50]
    entries = modelling.vector_entries(model.transform(new.withColumn("id", F.lit(9))), ["id"], "features").collect()
    assert [(r.id, r.position, r.value) for r in entries] == [(9, 0, 1.0), (9, 6, 1.0), (9, 7, 50.0)]


def test_classifier_learns(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(600):
        sex, age = str(rng.choice(["f", "m"])), float(rng.uniform(0, 80))
        rows.append((int((sex == "f") ^ (age < 20)), sex, age))
    df = spark.createDataFrame(rows, "y int, sex string, age double")
    model = modelling.train_classifier(df, "y", ["sex"], ["age"])
    got = binary_metrics(modelling.positive_probability(model.transform(df)), "y", "p").first()
    assert got.n == 600 and got.accuracy > 0.9 and got.auc > 0.95 and got.loss < 0.3


def test_term_weights_by_hand(spark):
    df = spark.createDataFrame([(1, "Red cup, red"), (2, "blue cup"), (3, "red cup red"), (4, None), (5, "Ärger é 7")], "id int, t string")
    counts = terms.term_counts(df, "id", "t")
    assert sorted(tuple(r) for r in counts.collect() if r.id in (1, 5)) == [(1, "cup", 1), (1, "red", 2), (5, "7", 1), (5, "ärger", 1), (5, "é", 1)]
    rarity = terms.term_rarity(counts, df)
    known = {r.term: r.rarity for r in rarity.collect()}
    assert known["cup"] == pytest.approx(np.log(6 / 4)) and known["blue"] == pytest.approx(np.log(6 / 2))
    weights = terms.term_weights(counts, rarity)
    asked = weights.filter("id = 1").select("term", "weight")
    got = {r.id: r.similarity for r in terms.text_similarity(weights, "id", asked).collect()}
    assert got[1] == pytest.approx(1) and got[3] == pytest.approx(1) and 0 < got[2] < 0.5 and got[5] == 0


def test_classifier_beats_the_base_rate(spark):
    folder = "/root/testdata/sf0.01"
    got = learning.train_eval_classifier(spark, folder).first()
    split = learning.classifier_split(spark, folder).filter("fold = 0").first()
    base = split.positives / split.n
    assert got.n == split.n and got.auc > 0.8 and got.precision > base and got.accuracy > base


def test_embed_and_search(spark):
    def make_encoder():
        return lambda texts: [[t.count("a"), t.count("b"), 1.0] for t in texts]

    df = spark.createDataFrame([(1, "aaa"), (2, "bbb"), (3, None)], "id int, t string")
    embedded = similarity.embed_text(df, "t", make_encoder)
    assert {r.id: r.embedding for r in embedded.collect()} == {1: [3, 0, 1], 2: [0, 3, 1], 3: [0, 0, 1]}
    scored = similarity.score_against(embedded, "embedding", [0.0, 2.0, 0.0])
    assert similarity.most_similar(scored, "id").first().id == 2
    by_row = similarity.score_against_row(embedded, "embedding", embedded.filter("id = 1"), "embedding")
    assert {r.id: r.similarity for r in by_row.collect()} == pytest.approx(
        {1: 1.0, 2: 1 / 10, 3: 1 / np.sqrt(10)}, rel=1e-6
    )


def test_forward(spark):
    rng = np.random.default_rng(2)
    x, w1, b1, w2, b2 = (rng.normal(size=s) for s in ((50, 4), (3, 4), 3, (2, 3), 2))
    rows = [(i, [float(v) for v in row] if i != 7 else None) for i, row in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, v array<float>").repartition(3)
    network = [Layer(w1.tolist(), b1.tolist(), relu=True), Layer(w2.tolist(), b2.tolist())]
    got = {r.id: r.out for r in forward(df, "v", network, "out").collect()}
    want = np.maximum(x.astype(np.float32) @ w1.T + b1, 0) @ w2.T + b2
    assert got.pop(7) is None
    assert all(np.allclose(got[i], want[i], atol=1e-5) for i in got) and len(got) == 49


def test_forward_refuses_other_lengths(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0, 3.0, 4.0],)], "v array<double>").coalesce(1)
    with pytest.raises(Exception, match="length 3"):
        forward(df, "v", [Layer([[1.0, 1.0, 1.0]], [0.0])], "out").collect()
