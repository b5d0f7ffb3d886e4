import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import filters, params, ranking, reshape
from ledgerloom.plans import panel


@pytest.fixture(scope="module")
def long(spark):
    rows = [(c, y, f"m{m}", float(y * 10 + m)) for c in ("A", "B", "C D") for y in (2015, 2016) for m in (1, 2)]
    return spark.createDataFrame(rows, "county string, year int, metric string, value double")


@pytest.mark.parametrize("columns", [["A", "B", "C D"], None])
def test_wide_and_back(long, columns):
    wide = reshape.long_to_wide(long, ["year", "metric"], "county", "value", columns)
    back = reshape.wide_to_long(wide, ["year", "metric"], ["A", "B", "C D"], "county", "value")
    assert sorted(map(tuple, back.select(*long.columns).collect())) == sorted(map(tuple, long.collect()))


def test_stack(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2.5)], "s string, v double")
    assert [tuple(r) for r in reshape.stack([a, b]).orderBy("s").collect()] == [(1, "x", None), (None, "y", 2.5)]


MAPPING = [(2015, 2016, "Old!!Income", "income"), (2017, 9999, "New!!Income", "income"), (2015, 9999, "Error", "error")]


def test_headings(spark):
    rows = [("A", 2015, "Old!!Income"), ("A", 2017, "New!!Income"), ("A", 2015, "Error"), ("A", 2015, "Other"), ("A", 2017, "Old!!Income")]
    long = spark.createDataFrame(rows, "county string, year int, label string")
    got = reshape.map_headings(long, MAPPING).select("year", "metric").collect()
    assert sorted(map(tuple, got)) == [(2015, "error"), (2015, "income"), (2017, "income")]
    # The error heading is missing in 2017.
    assert [tuple(r) for r in reshape.heading_faults(long, MAPPING).collect()] == [(2017, "error", 0)]


def test_balanced_panel(spark):
    rows = [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 3), ("c", 1), ("c", 2), ("c", 3), ("c", 3)]
    df = spark.createDataFrame(rows, "k string, y int")
    assert sorted(map(tuple, reshape.balanced_panel(df, "k", "y").collect())) == sorted(r for r in rows if r[0] != "b")
    once = df.distinct()
    got = reshape.balanced_panel(once, "k", "y", one_row_each=True).collect()
    assert sorted(map(tuple, got)) == sorted({r for r in rows if r[0] != "b"})


def test_key_set_difference(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 2), ("c", 2), ("d", 3)], "k string, y int")
    got = reshape.key_set_difference(df, "k", F.col("y") == 1, F.col("y") == 2).collect()
    assert sorted(map(tuple, got)) == [("b", "first"), ("c", "second")]


def test_columns_numbered(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b c` string")
    got = [tuple(r) for r in reshape.columns_numbered(df).collect()]
    assert got == [(0, "a", "0_a", 2), (1, "b c", "1_b c", 1)]


def test_first_per_key_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.random(), f"v{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "k int, t double, v string").repartition(7)
    want = {}
    for k, t, v in rows:
        want[k] = min(want.get(k, (2.0, "")), (t, v))
    assert {r.k: (r.t, r.v) for r in ranking.first_per_key(df, ["k"], ["t"]).collect()} == want


def test_top_k_is_one_pass(long, plan):
    top = ranking.top_k(long, 2, "value", ["county", "metric"])
    assert [r.county for r in top.collect()] == ["A", "B"]
    assert "TakeOrderedAndProject" in plan(top)


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, v double")
    assert [r.s for r in ranking.share_of_total(df, "v", "s").orderBy("k").collect()] == [25.0, 75.0]


def test_filters(spark):
    df = spark.createDataFrame([("CARRIAGE POSTAGE", "C12", "UK"), ("PARTY BUNTING", "12", "FR"), ("CUP", "13", "DE")], "d string, i string, c string")
    assert df.filter(filters.suffix_or_equal(F.col("d"), "POSTAGE", "PARTY BUNTING")).count() == 2
    assert df.filter(filters.is_cancelled(F.col("i"))).count() == 1
    assert filters.filter_if_any(df, "c", []).count() == 3
    assert filters.filter_if_any(df, "c", ["UK", "DE"]).count() == 2
    listed = filters.with_threshold(df, "c", {"UK": 75000, "FR": 2000.5}, "t").collect()
    assert {r.c: float(r.t) for r in listed} == {"UK": 75000.0, "FR": 2000.5}


def test_date_range_includes_both_ends(spark):
    df = spark.createDataFrame([(datetime.date(2023, 8, d),) for d in (18, 19, 20, 21)], "d date")
    chosen = df.filter(filters.in_date_range(F.col("d"), datetime.date(2023, 8, 19), datetime.date(2023, 8, 20)))
    assert chosen.count() == 2


def test_trailing_window(spark):
    df = spark.createDataFrame([(s,) for s in (1, 5, 9, 10, 10)], "sol int")
    assert sorted(r.sol for r in filters.trailing_window(df, "sol", 2).collect()) == [9, 10, 10]


def test_parameter_tables(spark):
    columns = {"n": "int", "s": "string"}
    short = params.parameter_table(spark, [(1, "a"), (2, None)], columns)
    assert sorted(map(tuple, short.collect())) == [(1, "a"), (2, None)]
    assert params.parameter_table(spark, [], columns).collect() == []
    joined = spark.range(3).join(short, F.col("id") == F.col("n"))
    assert "hint" not in joined._jdf.queryExecution().optimizedPlan().toString().lower()


def test_heading_faults(spark):
    mapping = [(2000, 2001, "A", "m"), (2002, 2003, "B", "m"), (2000, 2003, "C", "n")]
    rows = [(2000, "A"), (2000, "C"), (2001, "A"), (2001, "C"), (2002, "A"), (2002, "C"), (2003, "B"), (2003, "unknown")]
    long = spark.createDataFrame(rows, "year int, label string")
    faults = sorted(tuple(r) for r in reshape.heading_faults(long, mapping).collect())
    assert faults == [(2002, "m", 0), (2003, "n", 0)]
    mapped = sorted(tuple(r) for r in reshape.map_headings(long, mapping).select("year", "metric").collect())
    assert (2003, "n") not in mapped and (2002, "m") not in mapped and len(mapped) == 6


def test_too_many_columns_are_refused(spark, monkeypatch):
    monkeypatch.setattr(panel, "MOST_COLUMNS", 24)
    with pytest.raises(ValueError, match="more than 24"):
        panel.counties(spark, "/root/testdata/sf0.001")
