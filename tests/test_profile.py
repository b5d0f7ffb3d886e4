import random

import numpy as np
import pytest
from pyspark.sql import Row, functions as F

from ledgerloom.operators import evaluation, profile


@pytest.fixture(scope="module")
def numbers():
    rng = random.Random(5)
    usual = [round(rng.gauss(0, 10), 3) for _ in range(500)]
    return usual + [1e12, -1e9, 0.0, 0.0, 5.0, 5.0, 5.0]


@pytest.fixture(scope="module")
def table(spark, numbers):
    rows = [(float(x), float(i % 7)) for i, x in enumerate(numbers)] + [(None, None)]
    return spark.createDataFrame(rows, "a double, b double")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 507])
def test_quantiles(spark, numbers, n):
    some = numbers[-n:]
    df = spark.createDataFrame([(float(x),) for x in some], "a double")
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r.point: r.value for r in profile.quantiles(df, ["a"], points).collect()}
    assert got == pytest.approx(dict(zip(points, np.quantile(some, points))))


def test_not_a_number_sorts_last(spark):
    """As Spark's percentile has it: NaN is the largest value."""
    nan = float("nan")
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, 4.0, nan, nan)], "a double")
    got = {r.point: r.value for r in profile.quantiles(df, ["a"]).collect()}
    assert got[0.25] == 2.25 and got[0.5] == 3.5 and np.isnan(got[0.75])
    scored = spark.createDataFrame([(0.1, 0), (0.2, 0), (nan, 1), (float("inf"), 1)], "p double, y int")
    assert evaluation.area_under_roc(scored, "y", "p").first().auc == 1


def test_describe(table, numbers):
    got = {r.column_name: r for r in profile.describe(table, ["a", "b"]).collect()}["a"]
    assert got.n == len(numbers)
    assert [got.mean, got["std"], got["min"], got.q25, got.q50, got.q75, got["max"]] == pytest.approx(
        [np.mean(numbers), np.std(numbers, ddof=1), min(numbers), *np.quantile(numbers, [0.25, 0.5, 0.75]), max(numbers)]
    )


def test_histogram(spark):
    values = [0, 0.5, 1, 2, 9.99, 10, 10, None]
    df = spark.createDataFrame([(v if v is None else float(v),) for v in values], "x double")
    got = sorted(profile.histogram(df, "x", 10).collect(), key=lambda r: r.bin)
    want, edges = np.histogram([v for v in values if v is not None], bins=10)
    assert [r.n for r in got] == list(want)
    assert [r.bin_from for r in got] == pytest.approx(list(edges[:-1]))
    same = profile.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4).collect()
    assert sum(r.n for r in same) == 2


def test_value_counts(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "c string")
    assert [tuple(r) for r in profile.value_counts(df, "c").collect()] == [("x", 2), ("y", 1)]


def test_label_rate(spark):
    df = spark.createDataFrame([("f", 1), ("f", 0), ("m", 0)], "sex string, survived int")
    assert {r.sex: r.rate for r in profile.label_rate(df, "sex", "survived").collect()} == {"f": 0.5, "m": 0.0}


def brute_auc(pairs):
    positives = [p for p, y in pairs if y == 1]
    negatives = [p for p, y in pairs if y == 0]
    won = sum((p > n) + (p == n) / 2 for p in positives for n in negatives)
    return won / (len(positives) * len(negatives))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_binary_metrics(spark, seed):
    rng = random.Random(seed)
    pairs = []
    for _ in range(300):
        y = rng.randint(0, 1)
        p = rng.choice([0.0, 1.0, 0.5, rng.random(), rng.random() ** 9, min(1.0, 0.3 * y + 0.7 * rng.random())])
        pairs.append((p, y))
    df = spark.createDataFrame(pairs, "p double, y int")
    got = evaluation.binary_metrics(df, "y", "p").first()
    p, y = np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])
    c = np.clip(p, 1e-7, 1 - 1e-7)
    called = p > 0.5
    assert got.n == 300
    assert got.auc == pytest.approx(brute_auc(pairs))
    assert got.loss == pytest.approx(np.mean(np.where(y == 1, -np.log(c), -np.log(1 - c))))
    assert got.accuracy == pytest.approx(np.mean(called == (y == 1)))
    assert got.precision == pytest.approx(np.mean(y[called] == 1))
    assert got.recall == pytest.approx(np.mean(called[y == 1]))


def test_regression_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "actual double, predicted double")
    got = evaluation.regression_error(df, F.col("actual"), F.col("predicted")).first()
    assert (got.n, got.mae, got.rmse) == (2, 1.5, pytest.approx(np.sqrt(2.5)))


def test_shuffled_batches(spark):
    df = spark.range(100)
    got = evaluation.shuffled_batches(df, "id", 1).collect()
    again = evaluation.shuffled_batches(df.repartition(5), "id", 1).collect()
    other = evaluation.shuffled_batches(df, "id", 2).collect()
    assert sorted(r.position for r in got) == list(range(1, 101))
    assert sorted(r.batch for r in got).count(0) == 32 and max(r.batch for r in got) == 3
    assert {r.id: r.position for r in got} == {r.id: r.position for r in again}
    assert {r.id: r.position for r in got} != {r.id: r.position for r in other}


def test_quantiles_of_many_rows_with_ties_and_nan(spark):
    """Enough rows for brackets; most lie outside of them."""
    rng = np.random.default_rng(4)
    cells = {"smooth": rng.normal(size=60_000), "ties": rng.integers(0, 5, 60_000).astype(float), "one": np.full(60_000, 3.0)}
    cells["wild"] = np.where(rng.random(60_000) < 0.3, -np.inf, rng.exponential(size=60_000) * 10.0 ** rng.integers(-300, 300, 60_000))
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*cells.values())], ", ".join(f"{c} double" for c in cells))
    points = [0.0, 0.001, 0.25, 0.5, 0.75, 0.9999, 1.0]
    got = {(r.column_name, r.point): r.value for r in profile.quantiles(df, list(cells), points).collect()}
    for c, values in cells.items():
        for p in points:
            rank = p * (len(values) - 1)
            low, high = np.sort(values)[[int(np.floor(rank)), int(np.ceil(rank))]].tolist()
            want = low if low == high else low + (high - low) * (rank % 1)
            assert got[c, p] == want or abs(got[c, p] - want) <= 1e-12 * abs(want), (c, p)
    with_nan = df.selectExpr("IF(smooth > 1, double('NaN'), smooth) AS x")
    top = {r.point: r.value for r in profile.quantiles(with_nan, ["x"], [0.5, 0.95]).collect()}
    assert top[0.5] == float(np.quantile(cells["smooth"], 0.5)) and top[0.95] != top[0.95]
    # a bracket that misses its rank is opened
    off = [r.asDict(True) for r in profile._measured(df, ["smooth"], [0.5]).collect()]
    off[0]["brackets"] = [Row(point=0.5, low=2.0, high=3.0)]
    assert profile._placed(df, [Row(**off[0])]).first().value == float(np.quantile(cells["smooth"], 0.5))
    inside = profile._measured(df, ["smooth"], [0.5]).selectExpr("inline(brackets)").first()
    assert ((cells["smooth"] >= inside.low) & (cells["smooth"] <= inside.high)).sum() < 600
