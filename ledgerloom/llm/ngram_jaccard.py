"""Documents whose n-gram sets have a Jaccard similarity of at least t, by an R-tree of count vectors.

Tokens (word shingles) are hashed into groups, and a document is the point of its group counts.  The
overlap of two documents is at most the sum of the smaller counts per group.  That bound works twice:

* Fine groups, one per token hash, ordered from rare to common.  If the smaller counts over a
  document's first n - need + 1 groups sum to zero, the rest cannot reach ``need``.  So the tree's
  upper boxes are the half-spaces "at least one token of group g", a point lies in the boxes of its
  first groups only, and two points without a common box never meet.
* Coarse groups, ``GROUPS`` per document.  Inside a box, points lie in leaf pages with the largest
  count per group as upper corner.  Pages, then points, whose summed minima are too small are
  dropped.

Pairs that survive are verified on the whole sets.  Equal sets are one point, boxes with equal points
one box.  Only the components are wanted, so pairs inside one known component are not searched again:
a first round takes each point's best few neighbours, the next the best partner in another component per
point and box, and the last all pairs of different components that share a box.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from .graph import components
from .hashing import Words, blocks, mix, shingle_sets, text_bytes
from .heavy import join_counted
from .storage import keep

GROUPS = 256
#: Groups by whose corpus count the fine groups are ordered.
ORDER_BITS = 18
CHUNK = 4096
PAGE = 256
#: The first round looks at so many neighbours in a box on either side and verifies so many per point.
NEAR, BEST = 6, 6
#: Boxes of at most so many points are compared without a page.
SMALL = 8
#: Rounds of best partners at most; the last round finds what they leave.
ROUNDS = 1


def need(a, b, t: int):
    """Least overlap of sets of a and b with 100 * overlap >= t * union."""
    return (t * (a + b) + 99 + t) // (100 + t)


def _sets(batch: pa.RecordBatch, k: int, words: Words) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(batch.column("text"))
    for first, last in blocks(offsets):
        flat, at = shingle_sets(*words.of(data, offsets[first : last + 1]), k)
        yield first, last, flat, at


def token_ranks(docs: DataFrame, k: int) -> np.ndarray:
    """Rank of every order group by the number of documents' tokens in it; 2 ** ORDER_BITS numbers, whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = Words(), np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            for _, _, flat, _ in _sets(batch, k, words):
                total += np.bincount((flat >> np.uint64(64 - ORDER_BITS)).astype(np.int64), minlength=len(total))
        parts = total.reshape(-1, CHUNK)
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(range(len(parts)), pa.int32()), "counts": [p.tobytes() for p in parts]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[chunk] = total.get(chunk, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array(list(total), pa.int32()), "counts": pa.array([v.tobytes() for v in total.values()], pa.binary())}
        )

    schema = "chunk int, counts binary"
    summed = docs.select("text").mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema)
    counts = np.zeros((1 << ORDER_BITS) // CHUNK * CHUNK, np.int64).reshape(-1, CHUNK)
    for row in summed.collect():  # 2 ** ORDER_BITS numbers
        counts[row.chunk] = np.frombuffer(row.counts, np.int64)
    ranks = np.empty(counts.size, np.uint64)
    ranks[np.argsort(counts.ravel(), kind="stable")] = np.arange(counts.size, dtype=np.uint64)
    return ranks


def points(docs: DataFrame, k: int, t: int, shipped: Broadcast) -> DataFrame:
    """docs (id, text) to (id, n, s1, s2, counts, boxes): set size, set digest, coarse counts, boxes; shipped are token_ranks."""
    low = np.uint64((1 << (64 - ORDER_BITS)) - 1)

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, order = Words(), shipped.value
        for batch in batches:
            for first, last, flat, at in _sets(batch, k, words):
                docs_n = last - first
                sizes = np.diff(at)
                owner = np.repeat(np.arange(docs_n), sizes)
                group = (mix(flat) >> np.uint64(56)).astype(np.int64)
                counts = np.minimum(np.bincount(owner * GROUPS + group, minlength=docs_n * GROUPS), 255).astype(np.uint8).reshape(docs_n, GROUPS)
                digest = []
                for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(flat ^ np.uint64(salt)))])
                    digest.append(mix(sums[at[1:]] - sums[at[:-1]] + sizes.astype(np.uint64)).view(np.int64))
                place = (order[flat >> np.uint64(64 - ORDER_BITS)] << np.uint64(64 - ORDER_BITS)) | (flat & low)
                chosen, lengths = [], np.zeros(docs_n, np.int64)
                for i in np.flatnonzero(sizes):
                    own, n = place[at[i] : at[i + 1]], int(sizes[i])
                    take = n - (t * n + 99) // 100 + 1
                    lengths[i] = take
                    chosen.append(np.partition(own, take - 1)[:take] if take < n else own)
                boxes = np.concatenate(chosen).view(np.int64) if chosen else np.empty(0, np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column("id").slice(first, docs_n),
                        "n": pa.array(sizes),
                        "s1": digest[0],
                        "s2": digest[1],
                        "counts": pa.array([c.tobytes() for c in counts], pa.binary()),
                        "boxes": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(boxes)),
                    }
                )

    return docs.mapInArrow(point, "id long, n long, s1 long, s2 long, counts binary, boxes array<long>")


def excess(n: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Tokens beyond the 255 that a group's byte can count; few documents have any."""
    return n - counts.sum(axis=1, dtype=np.int64)


def bounds(counts1: np.ndarray, counts2: np.ndarray, excess1, excess2) -> np.ndarray:
    """Largest possible overlap: the sum of the smaller counts, and of what the bytes leave out."""
    return np.minimum(counts1, counts2).sum(axis=-1, dtype=np.int64) + np.minimum(excess1, excess2)


def _rows(batch: pa.RecordBatch, *more: str) -> tuple[np.ndarray, ...]:
    """(box, node, n, counts, excess, ...)"""
    box, node, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("box", "node", "n"))
    counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.uint8).reshape(-1, GROUPS)
    return box, node, n, counts, excess(n, counts), *(batch.column(c).to_numpy(zero_copy_only=False) for c in more)


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(x) for x in zip(*parts)) if len(parts) > 1 else parts[0]


def _apart(rows: tuple[np.ndarray, ...], i: np.ndarray, d: int, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the places i, those whose row and the row d further on survive; and their bounds."""
    _, _, n, counts, over, *_ = rows
    kept, found = [], []
    for part in np.array_split(i, len(i) // 8000 + 1):
        bound = bounds(counts[part], counts[part + d], over[part], over[part + d])
        ok = bound >= need(n[part], n[part + d], t)
        kept.append(part[ok])
        found.append(bound[ok])
    return np.concatenate(kept), np.concatenate(found)


def near_pairs(boxed: DataFrame, t: int) -> DataFrame:
    """boxed (box, node, n, counts) sorted by box and n; pairs of near rows of a box whose bound is large enough, with it."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            old = len(tail[0][0]) if tail else 0
            rows = _joined([*tail, _rows(batch)])
            box, node, n = rows[:3]
            for d in range(1, min(NEAR, len(box) - 1) + 1):
                i = np.flatnonzero((box[d:] == box[:-d]) & (node[d:] != node[:-d]))
                a, bound = _apart(rows, i[i + d >= old], d, t)
                if len(a):
                    ratio = bound / (n[a] + n[a + d] - bound)
                    yield pa.RecordBatch.from_pydict({"a": node[a], "b": node[a + d], "ratio": ratio})
            tail = [tuple(x[-NEAR:] for x in rows)]

    return boxed.mapInArrow(search, "a long, b long, ratio double")


def _surviving(one: tuple[np.ndarray, ...], two: tuple[np.ndarray, ...], t: int, same: bool, best: bool) -> Iterator[np.ndarray]:
    """Pairs (a, b) of two pages with different labels and a large enough bound; with ``best`` one for each point of the first."""
    _, node1, n1, counts1, over1, label1 = one
    _, node2, n2, counts2, over2, label2 = two
    # the pages' boxes: no pair inside has a larger bound, or needs less than the smallest sizes do
    if bounds(counts1.max(axis=0), counts2.max(axis=0), over1.max(), over2.max()) < need(n1.min(), n2.min(), t):
        return
    for i in range(len(node1)):
        j = np.flatnonzero((label2 != label1[i]) & (np.minimum(n1[i], n2) >= need(n1[i], n2, t)))
        if same and not best:
            j = j[j > i]
        if len(j):
            bound = bounds(counts1[i], counts2[j], over1[i], over2[j])
            ok = bound >= need(n1[i], n2[j], t)
            j, bound = j[ok], bound[ok]
            if len(j) and best:
                j = j[[(bound / (n1[i] + n2[j] - bound)).argmax()]]
            if len(j):
                yield np.stack([np.full(len(j), node1[i]), node2[j]])


PAGE_COLUMNS = ("nodes", "sizes", "counts", "labels")


def far_pairs(boxed: DataFrame, t: int, best: bool) -> DataFrame:
    """boxed (box, node, n, counts, label) sorted by box, label and n; pairs of a box with different labels that survive.

    All of them, or with ``best`` the best one per point of a larger box, page by page.

    A box is cut into pages of ``PAGE`` points.  The pages of a box with more than one meet in a join, so a
    box with very many points is the work of many tasks.
    """

    def paged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[tuple[np.ndarray, ...]] = []
        long_box, number = None, 0  # the box that has been cut into pages so far, and their number

        def out(a, b) -> pa.RecordBatch:
            empty = {c: pa.nulls(len(a), pa.binary()) for c in PAGE_COLUMNS}
            nothing = pa.nulls(len(a), pa.int64())
            return pa.RecordBatch.from_pydict({"a": a, "b": b, "box": nothing, "page": nothing} | empty)

        def page(rows: tuple[np.ndarray, ...], alone: bool) -> Iterator[pa.RecordBatch]:
            if pairs := list(_surviving(rows, rows, t, True, best)):
                yield out(*np.concatenate(pairs, axis=1))
            if not alone:
                box, node, n, counts, _, label = rows
                packed = {c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(PAGE_COLUMNS, (node, n, counts, label))}
                nothing = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_pydict({"a": nothing, "b": nothing, "box": pa.array(box[:1]), "page": pa.array([number], pa.int64())} | packed)

        def run(rows: tuple[np.ndarray, ...], ended: bool) -> Iterator[pa.RecordBatch]:
            """Pages of a large box; what is left of one that goes on is carried."""
            nonlocal carry, long_box, number
            box = rows[0][0]
            if box != long_box:
                long_box, number = box, 0
            at, size = 0, len(rows[0])
            while size - at >= PAGE or (ended and at < size):
                cut = tuple(x[at : at + PAGE] for x in rows)
                yield from page(cut, ended and number == 0 and at + PAGE >= size)
                number, at = number + 1, at + PAGE
            if at < size:
                carry = [tuple(x[at:] for x in rows)]

        def closed(rows: tuple[np.ndarray, ...], edges: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Boxes that are there whole, or to their end."""
            box, node, label = rows[0], rows[1], rows[5]
            size = np.diff(edges)
            small = np.repeat((size <= SMALL) & (box[edges[:-1]] != (long_box if long_box is not None else box[0] - 1)), size)
            for d in range(1, min(SMALL, len(box))):
                i = np.flatnonzero(small[:-d] & (box[d:] == box[:-d]) & (label[d:] != label[:-d]))
                if not len(i):
                    continue
                a, _ = _apart(rows, i, d, t)
                if len(a):
                    yield out(node[a], node[a + d])
            for x, y in zip(edges[:-1], edges[1:]):
                if not small[x]:
                    yield from run(tuple(c[x:y] for c in rows), True)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _joined([*carry, _rows(batch, "label")])
            carry = []
            box = rows[0]
            edges = np.concatenate([[0], np.flatnonzero(box[1:] != box[:-1]) + 1])
            last = edges[-1]
            if len(edges) > 1:
                yield from closed(tuple(c[:last] for c in rows), edges)
            rest = tuple(c[last:] for c in rows)
            if len(rest[0]) >= PAGE or rest[0][0] == long_box:
                yield from run(rest, False)
            else:
                carry = [rest]
        if carry:
            rows = carry[0]
            yield from closed(rows, np.array([0, len(rows[0])]))

    def unpacked(row: dict, side: str) -> tuple[np.ndarray, ...]:
        node, n, label = (np.frombuffer(row[f"{c}{side}"], np.int64) for c in ("nodes", "sizes", "labels"))
        counts = np.frombuffer(row[f"counts{side}"], np.uint8).reshape(-1, GROUPS)
        return node, node, n, counts, excess(n, counts), label

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                one, two = unpacked(row, "1"), unpacked(row, "2")
                for x, y in ((one, two), (two, one)) if best else ((one, two),):
                    if pairs := list(_surviving(x, y, t, False, best)):
                        a, b = np.concatenate(pairs, axis=1)
                        yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    schema = "a long, b long, box long, page long, " + ", ".join(f"{c} binary" for c in PAGE_COLUMNS)
    found = keep(boxed.mapInArrow(paged, schema), "jaccard-pages")
    pages = found.filter("nodes IS NOT NULL")
    left, right = (pages.select("box", *[F.col(c).alias(f"{c}{s}") for c in ("page", *PAGE_COLUMNS)]) for s in ("1", "2"))
    met = left.join(right, "box").filter("page1 < page2").mapInArrow(meet, "a long, b long")
    return found.filter("nodes IS NULL").select("a", "b").unionByName(met)


def token_sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, tokens): whole sorted sets of the wanted documents as packed numbers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for first, last, flat, at in _sets(batch, k, words):
                sets = [flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_pydict({"node": batch.column("id").slice(first, last - first), "tokens": pa.array(sets, pa.binary())})

    wanted = docs.join(nodes.select(F.col("node").alias("id")), "id", "left_semi")
    return keep(wanted.mapInArrow(pack, "node long, tokens binary"), "jaccard-sets")


def verified(pairs: DataFrame, sets: DataFrame, t: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= t * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    first = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def different_boxes(boxes: DataFrame) -> DataFrame:
    """(box, node), each once; those of one box of the boxes that hold the same nodes, told by count and 128 bits of hash."""
    sides = [F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit("box"), F.col("node"))).alias("y")]
    alike = boxes.groupBy("box").agg(F.count("*").alias("n"), *sides)
    return boxes.join(alike.groupBy("n", "x", "y").agg(F.min("box").alias("box")).select("box"), "box", "left_semi")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable by links, itself included).

    Two documents link when 100 * common >= percent * union of their sets of ``words``-word shingles,
    A-Z lower-cased, words cut at ASCII white space.  Null and empty texts have an empty set and no
    link.  Rows that repeat an id are one document to the links.  Rows with a null id get a null
    component and link with nothing.  Other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = rows.filter("id IS NOT NULL")
    shipped = docs.sparkSession.sparkContext.broadcast(token_ranks(rows, words))  # 2 MB, fixed by ORDER_BITS
    all_points = keep(points(rows, words, percent, shipped).withColumn("row", F.monotonically_increasing_id()), "jaccard-points")
    shipped.destroy()  # the points are stored
    own = all_points.filter("id IS NOT NULL AND n > 0")
    firsts = own.groupBy("s1", "s2").agg(F.min(F.struct("id", "row")).alias("first"), F.count("*").alias("copies"))
    classes = keep(firsts.select("s1", "s2", F.col("first.id").alias("node"), F.col("first.row").alias("row"), "copies"), "jaccard-sets-once")
    # one row of each set, also where whole rows repeat
    single = keep(own.join(classes.select("row"), "row").select(F.col("id").alias("node"), "n", "counts", "boxes"), "jaccard-classes")
    by_box = Window.partitionBy("box").orderBy("node")
    boxes = single.select("node", F.explode("boxes").alias("box"))
    shared = boxes.withColumn("_p", F.lag("node").over(by_box)).withColumn("_n", F.lead("node").over(by_box))
    # a node with several sets may be in a box several times; different_boxes wants it once
    met = keep(shared.filter("_p <> node OR _n <> node").select("box", "node").distinct(), "jaccard-boxes")
    open_boxes = keep(different_boxes(met), "jaccard-open")
    shapes = single.select("node", "n", "counts")
    inside = open_boxes.join(shapes, "node")

    near = near_pairs(inside.repartition("box").sortWithinPartitions("box", "n", "node"), percent)
    found = near.groupBy("a", "b").agg(F.max("ratio").alias("ratio"))
    sided = found.union(found.select("b", "a", "ratio"))
    best = sided.groupBy("a").agg(F.slice(F.sort_array(F.collect_set(F.struct("ratio", "b")), False), 1, BEST).alias("best"))
    tested = keep(_ordered(best.select("a", F.explode("best.b").alias("b"))), "jaccard-near")
    sets = token_sets(known, _ends(tested), words)
    links = keep(verified(tested, sets, percent), "jaccard-links")

    rounds, last, label = 0, False, None
    while True:
        if label is None:
            label = keep(components(links), "jaccard-labels")
        labelled = open_boxes.join(label, "node", "left").select("box", "node", F.coalesce("component", "node").alias("label"))
        mixed = labelled.groupBy("box").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("box")
        left = labelled.join(mixed, "box", "left_semi").join(shapes, "node")
        far = far_pairs(left.repartition("box").sortWithinPartitions("box", "label", "n", "node"), percent, not last)
        # stored before the join, so that a pair of many boxes is one row there
        more = keep(keep(_ordered(far), "jaccard-far").join(tested, ["a", "b"], "left_anti"), "jaccard-untested")
        if not more.isEmpty():
            new = _ends(more).join(sets.select("node"), "node", "left_anti")
            if not new.isEmpty():
                sets = sets.unionByName(token_sets(known, new, words))
            tested = tested.unionByName(more)
            fresh = keep(verified(more, sets, percent), "jaccard-links")
            if not fresh.isEmpty():
                links, label = links.unionByName(fresh), None
        if last:
            break
        rounds += 1
        last = label is not None or rounds == ROUNDS  # nothing found: the last round looks at all that is left

    # an id that repeats with different texts holds their classes together
    member = join_counted(own.select("id", "n", "s1", "s2"), classes.drop("row"), ["s1", "s2"], "copies")
    member = keep(member.select("id", "n", "node"), "jaccard-members")
    several = member.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("_last")).filter("a < _last")
    ties = member.join(several, "id").select("a", F.col("node").alias("b")).filter("a <> b")
    found = label if label is not None and ties.isEmpty() else components(links.unionByName(ties))
    linked = member.join(found, "node", "left").select("id", "n", F.coalesce("component", "node").alias("component"))
    alone = all_points.filter("id IS NULL OR n = 0").select("id", "n", F.col("id").alias("component"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )
