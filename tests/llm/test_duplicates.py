"""Exact copies and shared lines."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.exact_dedup import content_groups, exact_duplicates
from ledgerloom.llm.line_dedup import LineRuns, falling_ranges, shared_line_dedup

from .tables import frame, odd_rows


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def exact_brute(rows):
    groups, left, out = {}, Counter(), []
    for i, text, *_ in rows:
        groups.setdefault(text or "", []).append(i)
    for i, text, *_ in rows:
        own = groups[text or ""]
        keep = max((x for x in own if x is not None), default=None)
        left[(i, text or "")] += 1
        out.append((i, keep, len(own), i == keep and left[(i, text or "")] == 1, sha(text)))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [None, lambda t: F.length(t) % 3, lambda t: F.lit(1)], ids=["sha256", "weak", "one"])
def test_exact_against_brute_force(spark, digest):
    rows = [*odd_rows(3), (None, "same", "en", "a"), (None, "same", "en", "a"), (7, None, None, None), (8, "", "en", "a")]
    found = exact_duplicates(frame(spark, rows), **({"digest": digest} if digest else {}), salts=3)
    assert sorted((tuple(r) for r in found.collect()), key=str) == exact_brute(rows)


def test_exact_empty_table(spark):
    assert exact_duplicates(frame(spark, [])).count() == 0


def test_copies_shrink_before_each_shuffle(spark):
    rows = spark.range(1000, numPartitions=4).select(F.col("id").alias("_id"), F.lit("t").alias("_text"), F.lit(1).alias("_digest"))
    assert [(r.keep_id, r.group_size) for r in content_groups(rows, 5).collect()] == [(999, 1000)]


def lines_brute(rows, min_chars=20, min_docs=3):
    docs = {(i, t or "") for i, t, *_ in rows if i is not None}
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, text in docs:
        for k in {key(x) for x in text.split("\n")}:
            if len(k) >= min_chars:
                holders.setdefault(k, []).append(i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), [])) < min_docs or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


LONG = "a line that is long enough"
LINES = [
    (1, f"{LONG}\n  {LONG.upper()} \t\nshort\n", "en", "a"),
    (2, f"x\n{LONG}\n\n{LONG}x", "en", "a"),
    (9, f"{LONG}", "en", "a"),
    (5, f"{LONG}x\r\n{LONG}x\nÄ{LONG}", "en", "a"),
    (6, f"ä{LONG}\n{LONG}x", "en", "a"),
    (6, "another text with the same id\n" + LONG, "en", "a"),
    (7, None, "en", "a"),
    (8, "", "en", "a"),
    (None, LONG, "en", "a"),
    (11, "z" * 20 + "\n" + "z" * 19, "en", "a"),
    (12, "z" * 20 + "\n" + "z" * 19, "en", "a"),
    (12, "z" * 20 + "\n" + "z" * 19, "en", "a"),
    (13, "z" * 20 + "\n" + "z" * 19 + "\n" + "z" * 20, "en", "a"),
    (14, "\n".join(f"line number {i} of a very long document" for i in range(5000)), "en", "a"),
    (15, "\n".join(f"line number {i} of a very long document" for i in range(0, 5000, 2)), "en", "a"),
    (16, "\n".join(f"line number {i} of a very long document" for i in range(0, 5000, 3)), "en", "a"),
]


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (5, 3)])
def test_lines_against_brute_force(spark, batches, fanout):
    found = shared_line_dedup(frame(spark, LINES), batches=batches, fanout=fanout)
    assert sorted((tuple(r) for r in found.collect()), key=str) == lines_brute(LINES)


def test_lines_of_an_empty_table(spark):
    assert shared_line_dedup(frame(spark, [])).count() == 0


def test_runs_are_levelled_and_say_the_same(spark):
    runs = LineRuns(fanout=2)
    for low in (40, 30, 20, 10, 0):
        runs.add(spark.createDataFrame([(low + i, i, 0) for i in range(5)] + [(low, 99, 1)], "id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    found = {r.h1: (r.top, r.holders) for r in runs.compacted().collect()}
    assert found == {**{i: (40 + i, 5) for i in range(5)}, 99: (40, 5)}


def test_falling_ranges_cover_all(spark):
    df = spark.createDataFrame([(i,) for i in range(100)], "id long")
    ranges = falling_ranges(df, "id", 4)
    assert len(ranges) == 4 and ranges[0][0] is None and ranges[-1][1] is None
    assert falling_ranges(df.filter("id < 0"), "id", 4) == [(None, None)]
