import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from ledgerloom.llm.sharding import range_number, sharded, splitters

from .tables import frame, odd_rows


def checked(rows, found, shards):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in found) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r.size
    return [sizes[k] for k in range(shards)]


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_rows(spark, seed):
    rows = [*odd_rows(seed), (None, "x", None, None), (None, None, None, None)]
    checked(rows, sharded(frame(spark, rows), 3).collect(), 3)


def test_near_equal_bytes_with_a_hot_group(spark):
    """A third of the rows are copies of one text; small groups stay whole."""
    rows = [(i, "the same text over and over" if i % 3 == 0 else f"text {i // 9} " * (1 + i % 5), "en", "a") for i in range(9000)]
    found = sharded(frame(spark, rows), 8, ranges=256).collect()
    sizes = checked(rows, found, 8)
    assert max(sizes) <= 1.02 * min(sizes)
    shards = defaultdict(set)
    for r in found:
        shards[r.text_crc32].add(r.shard)
    assert [len(s) for s in shards.values() if len(s) > 1] == [max(len(s) for s in shards.values())]


def test_few_rows_and_none(spark):
    rows = [(1, "a", "en", "a")]
    assert [(r.shard, r.slot) for r in sharded(frame(spark, rows), 8).collect()] == [(0, 0)]
    assert sharded(frame(spark, []), 8).count() == 0


def test_splitters_cut_heavy_keys_only():
    sample = pd.DataFrame({"k1": [5] * 60 + list(range(100, 140)), "k2": list(range(60)) + [0] * 40}, dtype=np.int64)
    b1, b2 = splitters(sample, 10)
    assert list(b1) == sorted(b1)
    lowest = np.iinfo(np.int64).min
    assert all(x == 5 for x, y in zip(b1, b2) if y != lowest) and (b1 == 5).sum() >= 5 and 6 in b1
    k1, k2 = np.array([4, 5, 5, 5, 6, 7, 200], np.int64), np.array([0, -9, 30, 59, 0, 0, 0], np.int64)
    numbers = range_number(k1, k2, b1, b2)
    plain = [sum((x, y) <= (p, q) for x, y in zip(b1, b2)) for p, q in zip(k1, k2)]
    assert list(numbers) == plain
