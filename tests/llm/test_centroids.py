import hashlib
import itertools
import math
import random

import numpy as np
import pytest

from ledgerloom.llm.centroids import LARGEST, candidates, clusters, curve_keys, hilbert_keys, kept_vectors, squared, zone_blocks
from ledgerloom.llm.queries import op13_centroid_clustering

COLUMNS = "vec_id long, embedding array<double>, label int, id long, cluster string, distance string, x int, ids int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 5, "c", "d", 2, 3) for i, v in rows], COLUMNS)


def brute(rows, k=16, rounds=3, dims=64):
    good = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [max(-LARGEST, min(LARGEST, math.floor(64 * x))) for x in v]) for i, v in good]
    first = sorted(zip(kept, good), key=lambda r: (r[1][0] is None, hashlib.sha256(f"1:{r[1][0]}".encode()).hexdigest(), r[1][1]))[:k]
    centroids = [v for (_, v), _ in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (_, n) in zip(kept, found) if n == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    total = {c: sum(d for d, n in found if n == c) for c in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    fits = lambda n: n if n < 2**63 else None
    return sorted(((i, n, d, fits(total[n]), fits(sum(total.values())), sha[n]) for (i, _), (d, n) in zip(kept, found)), key=str)


def vectors(seed, n, dims=64, spread=0.2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    return [(i * 3, [x + rng.gauss(0, spread) for x in rng.choice(centres)]) for i in range(n)]


def odd(seed):
    rows = vectors(seed, 150)
    rows += [(1000 + i, rows[0][1]) for i in range(80)]  # a common vector
    rows += [rows[1], rows[1], (rows[2][0], rows[3][1]), (None, rows[4][1]), (None, rows[4][1])]
    rows += [(2000, None), (2001, []), (2002, [0.5] * 63), (2003, [0.5] * 65), (2004, [0.5] * 63 + [None]), (2005, [math.nan] * 64)]
    rows += [(2006, [0.5] * 63 + [math.inf]), (2007, [-math.inf] + [0.5] * 63), (2008, [0.0] * 64), (2009, [-0.0001] * 64)]
    return rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [1, 7, 512])
def test_against_brute_force(spark, block):
    rows = odd(1)
    assert rows_of(clusters(frame(spark, rows), block=block)) == brute(rows)


def test_huge_components_and_few_vectors(spark):
    rows = [*vectors(3, 5), (7, [1e300] * 64), (8, [-1e300] * 64), (9, [2.0**20] * 64)]
    assert rows_of(clusters(frame(spark, rows))) == brute(rows)
    assert rows_of(clusters(frame(spark, rows), k=3, rounds=0)) == brute(rows, 3, 0)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(40)]  # equal starts: every later one stays empty
    found = rows_of(clusters(frame(spark, rows)))
    assert found == brute(rows) and len({r[1] for r in found}) == 2


def test_without_vectors(spark):
    assert clusters(frame(spark, [])).count() == 0
    assert clusters(frame(spark, [(1, None), (2, [1.0])])).count() == 0


def test_given_embeddings_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert rows_of(op13_centroid_clustering(spark, folder)) == brute(rows)


@pytest.mark.parametrize("axes,bits", [(1, 4), (2, 3), (3, 2), (4, 2)])
def test_the_curve_visits_neighbours(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    keys = [k.tobytes() for k in hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    order = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_boxes_keep_the_nearest_and_leave_out_others():
    rng = np.random.default_rng(5)
    left = 0
    for _ in range(60):
        centre = rng.integers(-300, 300, 64)
        values = centre + rng.integers(-20, 20, (50, 64))
        centroids = rng.integers(-300, 300, (16, 64))
        near = candidates(values.min(axis=0), values.max(axis=0), centroids)
        assert set(squared(values, centroids).argmin(axis=1)) <= set(near)
        left += 16 - len(near)
    assert left > 0


def test_distances_are_exact_when_large():
    values = np.array([[LARGEST] * 64, [-LARGEST] * 64, [LARGEST - 1] * 64])
    assert squared(values, values[1:]).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in values[1:]] for v in values]


def test_blocks_follow_the_curve_and_split_a_common_vector(spark):
    rows = [(i, [0.25] * 64) for i in range(4000)] + vectors(9, 2000)
    found = zone_blocks(kept_vectors(frame(spark, rows), "vec_id", "embedding", 64), 64, 64.0, block=100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = found.selectExpr("spark_partition_id() AS p", "size(ids) AS n").groupBy("p").sum("n").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(r[1] for r in sizes) < 2 * 6000 / 8 + 100 and sum(r[1] for r in sizes) == 6000
    for row in found.limit(20).collect():
        values = np.frombuffer(row.vectors, np.int32).reshape(-1, 64)
        keys = [k.tobytes() for k in curve_keys(values.astype(np.int64), 8)]
        assert keys == sorted(keys)
        assert (np.frombuffer(row.low, np.int32) == values.min(axis=0)).all() and (np.frombuffer(row.high, np.int32) == values.max(axis=0)).all()
