"""Centroid clustering in whole numbers, with zone maps along a space-filling curve.

Vectors are ordered along a Hilbert curve over a few fixed projections, dealt out by ranges of that order and
packed into blocks of ``BLOCK`` vectors with the least and largest value per component.  The box of a block
bounds its distances to every centroid, so a block is compared only with the centroids that can be nearest for one
of its vectors; that comparison is exact.  Blocks are written once and read in every round; what goes
back to the driver is a sum per centroid and component.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import keep

BLOCK = 512
#: Axes of the curve.  Each is the sum of all components with the signs of a Walsh function.
AXES = 8
#: Whole components beyond this count as this, so that every squared distance of 64 components fits a long.
LARGEST = 1 << 27
#: Below this all sums of squares are whole numbers that doubles hold exactly.
_EXACT_DOUBLE = 1 << 21


def hilbert_keys(places: np.ndarray, bits: int) -> np.ndarray:
    """places (rows, axes) of non-negative numbers below 2 ** bits; (rows, bytes): places on the Hilbert curve, in the order of bytes."""
    x = places.astype(np.uint64).T.copy()
    axes = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):  # undo the turns of the curve from the largest cells down
        low = np.uint64((1 << level) - 1)
        for a in range(axes):
            high = ((x[a] >> np.uint64(level)) & one).astype(bool)
            swap = np.where(high, np.uint64(0), (x[0] ^ x[a]) & low)
            x[0] ^= np.where(high, low, swap)
            x[a] ^= swap
    for a in range(1, axes):
        x[a] ^= x[a - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(level)) & one, np.uint64((1 << level) - 1), np.uint64(0))
    x ^= turn
    steps = np.stack([(x[a] >> np.uint64(level)) & one for level in range(bits - 1, -1, -1) for a in range(axes)], axis=1)
    return np.packbits(steps.astype(np.uint8), axis=1)


def walsh_signs(dims: int, axes: int) -> np.ndarray:
    """(dims, axes) of 1 and -1; column a has the parity of the bits that the place shares with a + 1."""
    shared = np.arange(dims)[:, None] & np.arange(1, axes + 1)[None, :]
    return 1 - 2 * np.array([[bin(v).count("1") & 1 for v in row] for row in shared], np.int64)


def whole_components(column: pa.Array, dims: int, scale: float) -> np.ndarray:
    """(rows, dims): floor(scale * x) of lists without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(flat * scale), -LARGEST, LARGEST).astype(np.int64).reshape(-1, dims)


def curve_keys(values: np.ndarray, axes: int) -> np.ndarray:
    dims = values.shape[1]
    bits = (2 * LARGEST * dims).bit_length()
    return hilbert_keys(values @ walsh_signs(dims, axes) + LARGEST * dims, bits)


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """(id, x) of the rows whose list has ``dims`` finite components."""
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x")).filter((F.size("x") == dims) & finite)


def zone_blocks(kept: DataFrame, dims: int, scale: float, block: int = BLOCK, axes: int = AXES) -> DataFrame:
    """kept (id, x); a row per block along the curve: ids, vectors (whole numbers), low and high per component.

    Equal vectors have one place on the curve; a hash of the id parts them, so a common vector fills several ranges.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = whole_components(batch.column("x"), dims, scale)
            keys = curve_keys(values, axes)
            rows = pa.array([v.tobytes() for v in values.astype(np.int32)], pa.binary())
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "place": pa.array([k.tobytes() for k in keys], pa.binary()), "vector": rows})

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(part: pa.Table) -> pa.RecordBatch:
            values = np.frombuffer(b"".join(part.column("vector").to_pylist()), np.int32).reshape(-1, dims)
            low, high = values.min(axis=0), values.max(axis=0)
            row = {"ids": [part.column("id").to_pylist()], "vectors": [values.tobytes()], "low": [low.tobytes()], "high": [high.tobytes()]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("vectors", "low", "high"))]))

        left: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            left = new if left is None else pa.concat_tables([left, new])
            while left.num_rows >= block:
                yield out(left.slice(0, block))
                left = left.slice(block)
        if left is not None and left.num_rows:
            yield out(left)

    placed = kept.mapInArrow(keyed, "id long, place binary, vector binary").withColumn("apart", F.xxhash64("id"))
    ordered = placed.repartitionByRange("place", "apart").sortWithinPartitions("place", "apart").select("id", "vector")
    return ordered.mapInArrow(packed, "ids array<long>, vectors binary, low binary, high binary")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest for a vector inside the box."""
    under, over = low - centroids, centroids - high
    least = (np.maximum(np.maximum(under, over), 0) ** 2).sum(axis=1)
    most = (np.maximum(np.abs(under), np.abs(over)) ** 2).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def squared(values: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(rows, centroids): exact squared distances."""
    if max(np.abs(values).max(initial=0), np.abs(centroids).max(initial=0)) < _EXACT_DOUBLE:
        v, c = values.astype(np.float64), centroids.astype(np.float64)
        return ((v**2).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c**2).sum(axis=1)[None, :]).astype(np.int64)
    return np.stack([((values - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def nearest(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block of the batch: its row, vectors, nearest centroids (the smaller number of equal ones), distances."""
    dims = centroids.shape[1]
    for i in range(batch.num_rows):
        low, high = (np.frombuffer(batch.column(c)[i].as_py(), np.int32).astype(np.int64) for c in ("low", "high"))
        values = np.frombuffer(batch.column("vectors")[i].as_py(), np.int32).astype(np.int64).reshape(-1, dims)
        near = candidates(low, high, centroids)
        distances = squared(values, centroids[near])
        best = distances.argmin(axis=1)
        yield i, values, near[best], distances[np.arange(len(best)), best]


def cluster_sums(blocks: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """Vectors per centroid, and their sums per component; as many numbers as the centroids have, whatever the table."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, values, cluster, _ in nearest(batch, centroids):
                counts += np.bincount(cluster, minlength=k)
                for c in np.unique(cluster):
                    sums[c] += values[cluster == c].sum(axis=0)
        used = np.flatnonzero(counts)
        number, place = np.repeat(used, dims), np.tile(np.arange(dims), len(used))
        yield pa.RecordBatch.from_pydict({"cluster": number, "place": place, "n": counts[number], "total": sums[number, place]})

    parts = blocks.select("vectors", "low", "high").mapInArrow(add, "cluster long, place long, n long, total long")
    counts, sums = np.zeros(k, np.int64), [[0] * dims for _ in range(k)]
    for row in parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        counts[row.cluster], sums[row.cluster][row.place] = row.n, int(row.total)
    return counts, sums


def first_centroids(kept: DataFrame, k: int, dims: int, scale: float, seed: int) -> np.ndarray:
    """The vectors of the k rows with the smallest sha256 of ``seed:id``; null ids come last, equal ids go by their vectors."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = kept.orderBy(order.asc_nulls_last(), "x").limit(k).collect()
    return whole_components(pa.array([r.x for r in rows], pa.list_(pa.float64())), dims, scale)


def clusters(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: float = 64.0, seed: int = 1,
    id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Rows whose list is null, of another length than ``dims``, or has a null, NaN or infinite component are left
    out.  A component is floor(scale * x); beyond 2 ** 27 it counts as that.  Distances are squared; of equally near
    centroids the smaller number wins.  A round replaces each centroid by the floor of its vectors' mean; one without
    vectors stays.  With fewer vectors than k there are as many centroids as vectors.  Rows that repeat an id or a vector are
    rows of their own; null ids are clustered too and start a centroid only if ids are lacking.  An inertia that no long
    holds is null.  Other columns are not read; without vectors there are no rows.
    """
    kept = kept_vectors(vectors, id_col, vector_col, dims)
    centroids = first_centroids(kept, k, dims, scale, seed)
    blocks = keep(zone_blocks(kept, dims, scale, block), "zone-blocks")
    for _ in range(rounds if len(centroids) else 0):
        counts, sums = cluster_sums(blocks, centroids)
        centroids = np.array([[s // int(n) for s in own] if n else old for old, n, own in zip(centroids.tolist(), counts, sums)], np.int64)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, cluster, distance in nearest(batch, centroids):
                ids = batch.column("ids").slice(i, 1).flatten()
                yield pa.RecordBatch.from_pydict({"id": ids, "cluster": cluster.astype(np.int32), "distance": distance})

    assigned = keep(blocks.mapInArrow(assign, "id long, cluster int, distance long"), "assigned")
    inertia = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    own = [
        (c, fits(inertia.get(c, 0)), fits(sum(inertia.values())), sha256(",".join(map(str, x)).encode()).hexdigest())
        for c, x in enumerate(centroids.tolist())
    ]
    described = vectors.sparkSession.createDataFrame(own, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(described), "cluster").select(  # k rows
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
