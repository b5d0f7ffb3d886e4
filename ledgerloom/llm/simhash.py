"""Near copies by SimHash, linked by multi-index hashing.

A text's fingerprint has the bits that are set in over half of its shingles' hashes.  Two fingerprints that differ
in at most two bits either differ in at most one bit of the low half, or agree in the high half.  So each
fingerprint is entered in a table by either half, looks up the Hamming ball of radius 1 around its low half, and is
compared in full with what it meets.  Of the ball's neighbours only those with one more bit are looked up, as the
others look up this one.

A half that very many fingerprints share is split again, by the same rule on the quarters of the other half.  The
48 bits that are then fixed leave at most 2 ** 16 fingerprints.  Of the links of a bucket only a forest goes on,
so a bucket never becomes all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .graph import components
from .hashing import Words, blocks, text_bytes
from .heavy import join_counted
from .storage import keep

BITS = 64
DISTANCE = 2
SEED = 42
#: A bucket with more table entries is split by the quarters of the other half.
LIMIT = 1024
#: Buckets of at most so many rows are compared side by side, many at a time.
SMALL = 12
#: Rows of one bucket that are held at once, besides its table entries; and rows of a block of comparisons.
HELD, SIDE = 1 << 16, 2048


def shingle_texts(words: Words, data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space between them, where the shingles start and end in that, and the text each belongs to."""
    low = offsets[0]
    data, offsets = data[low : offsets[-1]], offsets - low
    starts, ends = words.spans(data, offsets)
    kept = ~words.cut[data]
    between = ends[ends < len(data)]
    kept[between] = True  # the blank after a word; the first letter of the next text is kept anyway
    place = np.concatenate([[0], np.cumsum(kept)])
    flat = np.where(words.cut[data], np.uint8(0x20), words.lower[data])[kept].tobytes()
    owner = np.searchsorted(offsets, starts, "right") - 1
    bounds = np.searchsorted(starts, offsets)
    n = np.diff(bounds)
    nth = np.arange(len(starts)) - bounds[owner]
    size = np.minimum(k, n[owner])  # a text of fewer words is one shingle
    first = np.flatnonzero(nth + size <= n[owner])
    last = first + size[first] - 1
    return flat, place[starts[first]], place[starts[last]] + ends[last] - starts[last], owner[first]


def bit_counts(hashes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """(texts, 64): in how many of a text's hashes each bit is set."""
    counts = np.zeros((texts, BITS), np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own, where = np.unique(owner[i : i + (1 << 16)], return_index=True)
        counts[own] += np.add.reduceat(bits, where, axis=0, dtype=np.int64)
    return counts


def fingerprints(docs: DataFrame, k: int) -> DataFrame:
    """docs (id, text) to (id, fp): the fingerprint's 64 bits as a long; zero without words."""

    def simhash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, digest = Words(), xxhash.xxh64_intdigest
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in blocks(offsets):
                flat, starts, ends, owner = shingle_texts(words, data, offsets[first : last + 1], k)
                hashes = np.fromiter((digest(flat[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
                counts = bit_counts(hashes, owner, last - first)
                most = counts * 2 > np.bincount(owner, minlength=last - first)[:, None]
                fp = np.packbits(most, axis=1, bitorder="little").view("<i8").ravel()
                yield pa.RecordBatch.from_pydict({"id": batch.column("id").slice(first, last - first), "fp": fp})

    return docs.mapInArrow(simhash, "id long, fp long")


def half_keys(prints: DataFrame) -> DataFrame:
    """prints (fp, node) to (key, probe, fp, node): the entries of either half and the probes of the low one."""
    return prints.selectExpr("fp", "node", "fp & 4294967295L AS low", "shiftrightunsigned(fp, 32) AS high").selectExpr(
        "fp",
        "node",
        """inline(concat(
          array(named_struct('key', low, 'probe', false), named_struct('key', 4294967296L | high, 'probe', false)),
          transform(filter(sequence(0, 31), b -> shiftright(low, b) & 1 = 0),
            b -> named_struct('key', low | shiftleft(1L, b), 'probe', true))))""",
    )


def quarter_keys(rows: DataFrame) -> DataFrame:
    """Rows of half_keys to rows of the same form, the key with a quarter of the half that it leaves open."""
    split = rows.withColumn("open", F.expr("IF(key >= 4294967296L, fp & 4294967295L, shiftrightunsigned(fp, 32))"))
    quarters = split.selectExpr("fp", "node", "probe AS looks", "shiftleft(key, 17) AS base", "open & 65535L AS low", "shiftright(open, 16) | 65536L AS high")
    return quarters.selectExpr(
        "fp",
        "node",
        """inline(concat(
          array(named_struct('key', base | low, 'probe', looks), named_struct('key', base | high, 'probe', looks)),
          transform(filter(sequence(0, 15), b -> NOT looks AND shiftright(low, b) & 1 = 0),
            b -> named_struct('key', base | low | shiftleft(1L, b), 'probe', true))))""",
    )


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest place reachable from each of n places by the links (i, j)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked(rows: DataFrame, distance: int) -> DataFrame:
    """rows (key, probe, fp, node); links (a, b) between nodes that hold each bucket's near fingerprints together.

    An entry is compared with all entries and probes of its key; two probes are not.
    """

    def close(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.bitwise_count((x ^ y).view(np.uint64)) <= distance  # of a negative number the absolute value is counted

    def bucket(probe: np.ndarray, fp: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of one key, entries first."""
        n = int((~probe).sum())
        if not n:
            return
        ends = [np.empty((2, 0), np.int64)]
        label = np.arange(len(fp))
        for a in range(0, n, SIDE):
            for b in range(a, len(fp), SIDE * 8):
                i, j = np.nonzero(close(fp[a : min(n, a + SIDE), None], fp[None, b : b + SIDE * 8]))
                ends.append(np.stack([i + a, j + b]))
            label = _forest(*np.concatenate([*ends, np.stack([label, np.arange(len(fp))])], axis=1), len(fp))
            ends = []
        moved = np.flatnonzero(node != node[label])
        if len(moved):
            yield pa.RecordBatch.from_pydict({"a": node[label[moved]], "b": node[moved]})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "probe", "fp", "node")]
            key, probe, fp, node = rows = new if carry is None else [np.concatenate(x) for x in zip(carry, new)]
            last = np.searchsorted(key, key[-1])  # the last key may go on
            yield from whole(*(x[:last] for x in rows))
            carry = [x[last:] for x in rows]
            if len(carry[0]) > HELD:
                yield from bucket(*carry[1:])
                entries = ~carry[1]
                carry = [x[entries] for x in carry]
        if carry is not None:
            yield from whole(*carry)

    def whole(key: np.ndarray, probe: np.ndarray, fp: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole buckets, sorted by key, entries first."""
        if not len(key):
            return
        edges = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        sizes = np.diff(edges)
        small = np.repeat(sizes <= SMALL, sizes) & ~probe
        for d in range(1, min(SMALL, len(key))):
            i = np.flatnonzero(small[:-d] & (key[:-d] == key[d:]) & (node[:-d] != node[d:]))
            i = i[close(fp[i], fp[i + d])]
            if len(i):
                yield pa.RecordBatch.from_pydict({"a": node[i], "b": node[i + d]})
        for g in np.flatnonzero(sizes > SMALL):
            yield from bucket(*(x[edges[g] : edges[g + 1]] for x in (probe, fp, node)))

    dealt = rows.select("key", "probe", "fp", "node").repartition("key").sortWithinPartitions("key", "probe")
    return dealt.mapInArrow(search, "a long, b long")


def near_links(prints: DataFrame, limit: int = LIMIT, distance: int = DISTANCE) -> DataFrame:
    """prints (fp, node), each fp once; links (a, b) of nodes, enough of them for the components."""
    rows = half_keys(prints)
    crowded = keep(rows.filter("NOT probe").groupBy("key").count().filter(F.col("count") > limit).select("key"), "simhash-crowded")
    if crowded.isEmpty():
        return linked(rows, distance)
    split = quarter_keys(rows.join(crowded, "key", "left_semi"))
    return linked(rows.join(crowded, "key", "left_anti"), distance).unionByName(linked(split, distance))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, limit: int = LIMIT) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (smallest id reachable by links, itself included).

    Words are cut at ASCII white space, A-Z lower-cased; the shingles of a text, repeats included, are hashed by XXH64
    with seed 42.  A text with fewer words is one shingle; null and empty texts have the fingerprint zero, which links like
    any other.  Fingerprints link at two or fewer different bits; a text of any length is read whole.  Rows that repeat an id are one
    document to the links; rows with a null id have a null component and link with nothing.  Other columns are not
    read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    prints = keep(fingerprints(rows, words), "simhash-prints")
    known = prints.filter("id IS NOT NULL")
    classes = keep(known.groupBy("fp").agg(F.min("id").alias("node"), F.count("*").alias("n")), "simhash-classes")
    links = near_links(classes.select("fp", "node"), limit)
    # an id that repeats with different texts holds their classes together
    several = known.groupBy("id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).filter("x < y").select("id")
    again = join_counted(known.join(several, "id", "left_semi").distinct(), classes, ["fp"], "n")
    ties = again.select("id", "node").filter("id <> node").select(F.col("node").alias("a"), F.col("id").alias("b"))
    found = components(links.unionByName(ties))
    named = classes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component"), "n")
    placed = join_counted(known, keep(named, "simhash-named"), ["fp"], "n")
    return placed.unionByName(prints.filter("id IS NULL").withColumn("component", F.lit(None).cast("long"))).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )
