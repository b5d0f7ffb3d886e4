"""Benchmark passages in documents, found by spaced seeds and verified with substitutions allowed.

A seed is the hash of the words at a mask's positions, so a changed word at an ignored position does
not change it.  The two masks hit every ``WINDOW``-word window in which at most ``CHANGED`` words differ
(a test goes through all cases).  Documents send only seeds that a fixed-size bit filter of the benchmark's
seeds lets pass; an exact join on the hash then pairs them, and the words around each hit are
compared.  Item seeds with the same words around are one class, compared once for all its items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import NO_WORD, Words, blocks, mix, text_bytes, window_hash
from .storage import keep

WINDOW, CHANGED = 13, 2
MASKS = ((0, 1, 3, 6, 7, 8), (0, 1, 4, 5, 6, 8))
SPAN = 9
SIDE = WINDOW - SPAN
REACH = SPAN + 2 * SIDE
#: Items of fewer words than a window have to occur whole and unchanged; those below this are not looked for.
LEAST = 5
FILTER_BITS = 24
DOC_EDGE, ITEM_EDGE = np.uint64(1), np.uint64(2)  # stand for words beyond an end; never equal


def _salt(kind: int) -> np.uint64:
    return mix(np.array([kind], np.uint64))[0]


def _seeds(words: np.ndarray, places: np.ndarray, kind: int, mask: range | tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Seeds and their positions among all words, none over the end of a text."""
    span = max(mask) + 1
    hashes = window_hash(words, list(mask)) ^ _salt(kind)
    owner = np.repeat(np.arange(len(places) - 1), np.diff(places))
    at = np.flatnonzero(owner[: len(hashes)] == owner[span - 1 :]) if len(hashes) else np.empty(0, np.int64)
    return hashes[at], at


def _around(words: np.ndarray, low: int, high: int, at: int, edge: np.uint64) -> bytes:
    """The REACH words around a seed at ``at`` of a text [low, high)."""
    out = np.full(REACH, edge, np.uint64)
    a, b = max(low, at - SIDE), min(high, at + SPAN + SIDE)
    out[a - at + SIDE : b - at + SIDE] = words[a:b]
    return out.tobytes()


def _table(hashes: list, ids: list, at: list, around: list, short: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "hash": pa.array(hashes, pa.int64()), "id": pa.array(ids, pa.int64()), "at": pa.array(at, pa.int64()),
            "around": pa.array(around, pa.binary()), "short": pa.array(short, pa.int32()),
        }
    )


SCHEMA = "hash long, id long, at long, around binary, short int"


def item_seeds(items: DataFrame) -> DataFrame:
    """items (id, text); a row per seed: hash, id, at, around, short (words of a short item, else 0)."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Words(NO_WORD)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids = batch.column("id").to_pylist()
            for first, last in blocks(offsets):
                words, places = cutter.of(data, offsets[first : last + 1])
                rows: tuple[list, ...] = ([], [], [], [], [])
                for i, (a, b) in enumerate(zip(places[:-1], places[1:])):
                    n = int(b - a)
                    if LEAST <= n < WINDOW:
                        found = [(window_hash(words[a:b], range(n))[:1] ^ _salt(100 + n), [0], n)]
                    elif n >= WINDOW:
                        found = [(*_seeds(words[a:b], np.array([0, n]), kind, mask), 0) for kind, mask in enumerate(MASKS)]
                    else:
                        continue
                    for hashes, at, short in found:
                        for h, p in zip(hashes.view(np.int64).tolist(), at):
                            for column, value in zip(rows, (h, ids[first + i], int(p), None if short else _around(words, a, b, a + p, ITEM_EDGE), short)):
                                column.append(value)
                yield _table(*rows)

    return items.mapInArrow(seeds, SCHEMA)


def seed_filter(seeds: DataFrame) -> tuple[np.ndarray, list[int]]:
    """Bits of the seeds' hashes, 2 MB whatever the benchmark's size, and the lengths of short items (below WINDOW)."""
    bit = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    word = F.shiftright(bit, 6).cast("int").alias("word")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int")).alias("bits")
    words = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in seeds.select(word, one).groupBy("word").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        words[row.word] = row.bits
    short = [r.short for r in seeds.filter("short > 0").select("short").distinct().collect()]
    return words.view(np.uint64), short


def document_seeds(docs: DataFrame, bits: np.ndarray, short: list[int]) -> DataFrame:
    """docs (id, text); the seeds that pass the filter, as item_seeds has them."""
    shipped = docs.sparkSession.sparkContext.broadcast(bits)
    kinds = [*enumerate(MASKS), *((100 + n, range(n)) for n in short)]

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, own = Words(NO_WORD), shipped.value
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in blocks(offsets):
                words, places = cutter.of(data, offsets[first : last + 1])
                ids = batch.column("id").slice(first, last - first)
                for kind, mask in kinds:
                    hashes, at = _seeds(words, places, kind, mask)
                    bit = hashes >> np.uint64(64 - FILTER_BITS)
                    hit = np.flatnonzero((own[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1))
                    if not len(hit):
                        continue
                    at, doc = at[hit], np.searchsorted(places, at[hit], "right") - 1
                    around = [None if kind >= 100 else _around(words, places[d], places[d + 1], p, DOC_EDGE) for d, p in zip(doc, at)]
                    yield _table(
                        hashes[hit].view(np.int64), ids.take(pa.array(doc)), at - places[doc], around, [kind - 100 if kind >= 100 else 0] * len(hit)
                    )

    return docs.mapInArrow(seeds, SCHEMA)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, class, at, equal): every window around a hit that is equal enough; short items are equal as a whole."""
    for batch in batches:
        short, at = batch.column("short").to_numpy(), batch.column("at").to_numpy()
        row, place, equal = [np.flatnonzero(short > 0)], [at[short > 0]], [short[short > 0].astype(np.int64)]
        long = np.flatnonzero(short == 0)
        if len(long):
            x, y = (
                np.frombuffer(b"".join(batch.column(c).take(pa.array(long)).to_pylist()), np.uint64).reshape(-1, REACH) for c in ("around", "item_around")
            )
            same, inside = x == y, (x != DOC_EDGE) & (y != ITEM_EDGE)
            for s in range(REACH - WINDOW + 1):
                found = same[:, s : s + WINDOW].sum(axis=1)
                ok = (found >= WINDOW - CHANGED) & inside[:, s : s + WINDOW].all(axis=1)
                row.append(long[ok])
                place.append(at[long[ok]] - SIDE + s)
                equal.append(found[ok])
        rows = pa.array(np.concatenate(row))
        yield pa.RecordBatch.from_pydict(
            {"id": batch.column("id").take(rows), "class": batch.column("class").take(rows), "at": np.concatenate(place), "equal": np.concatenate(equal)}
        )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """One row per document and benchmark item that share a passage: id, item id, n_windows, best_equal, first_word.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.  A passage is a window of 13 words of
    which at least 11 are equal in place, or a whole item of 5 to 12 words.  Items with less are not looked for.  Items
    that share words have a row each.  ``n_windows`` counts the places in the document where such a window starts, ``first_word`` is the first
    of them, ``best_equal`` the equal words of the best.  Null texts have no words; rows with a null id (of either table) are left out, as no row could name
    them; rows that repeat an id count as one document.  Other columns are not read.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).filter("id IS NOT NULL")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id IS NOT NULL")
    seeds = keep(item_seeds(items).select("hash", "short", F.col("around").alias("item_around"), F.col("id").alias("item")).distinct(), "item-seeds")
    bits, short = seed_filter(seeds)
    key = ["hash", "short", "item_around"]
    classes = keep(seeds.select(*key).distinct().withColumn("class", F.monotonically_increasing_id()), "seed-classes")
    same = seeds.alias("s").join(classes.alias("c"), [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in key])
    members = same.select("class", "item")
    hits = document_seeds(rows, bits, short).join(classes, ["hash", "short"])
    found = hits.select("id", "class", "at", "short", "around", "item_around").mapInArrow(_compare, "id long, class long, at long, equal long")
    once = found.groupBy("id", "class", "at").agg(F.max("equal").alias("equal"))
    return (
        once.join(members, "class").groupBy("id", "item", "at").agg(F.max("equal").alias("equal"))
        .groupBy("id", "item").agg(F.count("*").alias("n_windows"), F.max("equal").alias("best_equal"), F.min("at").alias("first_word"))
        .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_windows", "best_equal", "first_word")
    )
