"""Running totals against a plain loop, with a key that holds most rows, null keys and many chunks."""

import random
import re
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from ledgerloom.operators.running import numbered, running_summary, running_total, value_step
from ledgerloom.plans import registry


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(2000):
        key = rng.choice(["hot"] * 6 + ["a", "b", None])
        value = None if i < 60 or rng.random() < 0.02 else Decimal(rng.randint(-5000, 9000)) / 100
        # The first rows are early and have no value.
        out.append((key, i // 20 + 1 if i < 60 else rng.randint(2, 12), i, value))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    df = spark.createDataFrame(rows, "k string, day int, id int, v decimal(18,2)")
    return df.withColumn("block", F.floor(F.col("id") / 100))


def expected(rows):
    """id -> running total, by a loop; null until the key's first value."""
    so_far, out = {}, {}
    for key, _, i, value in sorted(rows, key=lambda r: (r[1], r[2])):
        if value is not None:
            so_far[key] = so_far.get(key, 0) + value
        out[i] = so_far.get(key)
    return out


@pytest.mark.parametrize("levels", [[], ["day"], ["day", "block"]])
def test_running_total(table, rows, levels):
    got = running_total(table, ["k"], ["day", "id"], "v", "t", levels).collect()
    assert len(got) == len(rows)
    assert {r.id: r.t for r in got} == expected(rows)


@pytest.mark.parametrize("levels", [["day"], ["day", "block"]])
def test_running_summary(table, rows, levels):
    totals = expected(rows)
    groups = defaultdict(list)
    for key, day, i, value in rows:
        groups[key, day].append((totals[i], value or 0))
    got = running_summary(table, ["k"], ["day", "id"], "v", levels).collect()
    assert len(got) == len(groups)
    for r in got:
        group = groups[r.k, r.day]
        running = [t for t, _ in group if t is not None]
        assert (r.n_rows, r.n_valued) == (len(group), len(running))
        assert r.running_sum == (sum(running) if running else None)
        assert r.running_max == (max(running) if running else None)
        assert (r.total or 0) == sum(v for _, v in group)


def test_rows_are_sorted_per_chunk_only(table, plan):
    text = plan(running_summary(table, ["k"], ["day", "id"], "v", ["day", "block"]))
    windows = [line for line in text.splitlines() if "+- Window" in line]
    rowwise = [line for line in windows if "_value" in line]
    assert len(rowwise) == 1 and "windowspecdefinition(k" in rowwise[0] and "block" in rowwise[0].split("ASC")[0]


def test_building_the_plan_writes_nothing(spark, tmp_path, monkeypatch):
    started = []
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **b: started.append(a))
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: started.append(a))
    for name in ("running_item_revenue", "running_returns"):
        registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert not started


def test_last_total_is_the_sum(table, rows):
    got = running_total(table, ["k"], ["day", "id"], "v", "t", ["day"]).groupBy("k").agg(
        F.max_by("t", F.struct("day", "id")).alias("last"), F.sum("v").alias("all")
    )
    assert all(r.last == r["all"] for r in got.collect())


def test_numbered(table, rows):
    got = numbered(table, ["day", "id"], "n", ["day", "block"]).collect()
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    assert {r.id: r.n for r in got} == {r[2]: i + 1 for i, r in enumerate(order)}


def test_value_steps_grow_with_the_value(spark):
    values = sorted([float("inf"), float("-inf"), 0.0, 5e-324, 1e-300, 1e-9, 0.5, 1.0, 1.0000001, 3.0, 1e9, 1e308, -1e-9, -2.0, -1e300])
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", value_step(F.col("x")).alias("s"))
    steps = [r.s for r in sorted(df.collect(), key=lambda r: r.x)]
    assert steps == sorted(steps)
    nan = spark.range(1).select(value_step(F.lit(float("nan"))).alias("s")).first().s
    assert nan > max(steps)
    assert len(set(steps)) >= len(values) - 1


def test_keys_and_levels_move_once(table, plan):
    """The shuffle of the rows holds them in the chunk only, not a second time as columns."""
    text = plan(running_total(table, ["k"], ["day", "id"], "v", "t", ["day", "block"]))
    output = [re.search(r"\+- Project \[(.*)\]", text[m.start() :]).group(1) for m in re.finditer(r"Exchange hashpartitioning\(_chunk#", text)]
    rows = [columns for columns in output if "struct(" in columns and ", id#" in columns]
    assert rows and not [c for columns in rows for c in re.sub(r"struct\(.*?\) AS _chunk#\d+", "", columns).split(", ") if re.match(r"(k|day|block)#", c)]
