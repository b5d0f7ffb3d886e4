"""Many search vectors at once, in blocks: an index of buckets by random planes, and an exact way.

Similarity is the cosine, rounded to ``digits``; equal ones go by key.  Rows whose vector is null, holds nulls or
numbers that are not finite, or has no direction cannot be compared and are left out.  A row is not its own
neighbour; a query that shares its key with a row of another vector leaves that row out too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

#: Vectors of a block on either side of the exact way.
QUERY_BLOCK, ROW_BLOCK = 256, 2048


def directed(df: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """(key, v): vectors of length one."""
    x = F.transform(F.col(vector), lambda a: a.cast("double"))
    sound = F.forall("x", lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
    squares = F.aggregate("x", F.lit(0.0), lambda s, a: s + a * a)
    kept = df.select(F.col(key).alias("key"), x.alias("x")).filter((F.size("x") == dims) & sound).withColumn("l", F.sqrt(squares))
    return kept.filter("l > 0").select("key", F.transform("x", lambda a: a / F.col("l")).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _planes(dims: int, bits: int, seed: int = 7) -> np.ndarray:
    """Directions at right angles, one per bit and no more than there are dimensions."""
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, min(bits, dims))))[0]


def _codes(sides: np.ndarray) -> np.ndarray:
    return (sides > 0) @ (1 << np.arange(sides.shape[1]))


def bucketed(vectors: DataFrame, dims: int, bits: int) -> DataFrame:
    """vectors (key, v) with their bucket, the sides of ``bits`` planes they lie on; the rows of a bucket follow each other.

    Ranges of buckets and of hashed keys make the partitions, so that a bucket with many rows is spread.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = _planes(dims, bits)
        for batch in batches:
            yield batch.append_column("bucket", pa.array(_codes(_matrix(batch.column("v"), dims) @ planes), pa.int64()))

    coded = vectors.mapInArrow(hashed, f"key {vectors.schema['key'].dataType.simpleString()}, v array<double>, bucket long")
    return coded.repartitionByRange("bucket", F.xxhash64("key")).sortWithinPartitions("bucket")


def _visited(q: np.ndarray, planes: np.ndarray, share: float) -> np.ndarray:
    """Queries by buckets: the ``share`` of all buckets that a query looks into, nearest first by the planes between."""
    sides = q @ planes
    bits = planes.shape[1]
    turned = (np.arange(1 << bits)[:, None] >> np.arange(bits)) & 1
    n = int(np.ceil(share * (1 << bits)))
    nearest = np.argsort(np.abs(sides) @ turned.T, axis=1, kind="stable")[:, :n]
    visited = np.zeros((len(q), 1 << bits), bool)
    visited[np.arange(len(q))[:, None], _codes(sides)[:, None] ^ nearest] = True
    return visited


def best_of(pairs: DataFrame, k: int) -> DataFrame:
    """pairs (query, key, similarity) with place, from 1, up to k; Spark cuts to k before the shuffle too."""
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), "key")
    return pairs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _packed(vectors: DataFrame, size: int, keys: str, values: str) -> DataFrame:
    """Blocks of keys, vectors and buckets (if there are any) of a partition's rows."""
    kind = vectors.schema["key"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                flat = part.column("v").flatten().to_numpy(zero_copy_only=False)
                buckets = part.column("bucket").to_numpy().tobytes() if "bucket" in part.schema.names else None
                columns = [
                    pa.array([part.column("key").to_pylist()], pa.list_(part.column("key").type)), pa.array([flat.tobytes()], pa.binary()),
                    pa.array([buckets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [keys, values, f"{values}_buckets"])

    return vectors.mapInArrow(pack, f"{keys} array<{kind}>, {values} binary, {values}_buckets binary")


class _Asked:
    """A block of queries: the buckets that they look into, and their best similarities in the blocks of rows seen last."""

    def __init__(self, keys: pa.Array, q: np.ndarray, k: int):
        self.keys, self.names, self.q, self.k = keys, np.array(keys.to_pylist()), q, k
        self.best, self.visited = np.full((len(q), k), -np.inf), None

    def near(self, v: np.ndarray, buckets: np.ndarray | None, planes: np.ndarray, share: float) -> np.ndarray:
        if buckets is None:
            return self.q @ v.T
        if self.visited is None:
            self.visited = _visited(self.q, planes, share)
        near = np.full((len(self.q), len(v)), -np.inf)
        edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1), len(buckets)]
        for a, b in zip(edges[:-1], edges[1:]):
            asking = np.flatnonzero(self.visited[:, buckets[a]])
            near[asking, a:b] = self.q[asking] @ v[a:b].T
        return near

    def select(self, near: np.ndarray, right: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, similarity) of at most k rows per query; what is below k that were seen already stays out."""
        near[self.names[:, None] == right[None, :]] = -np.inf
        least = self.best.min(axis=1)
        if near.shape[1] > self.k and np.isinf(least).any():
            least = np.maximum(least, np.partition(near, -self.k, axis=1)[:, -self.k])
        # rounding may make equal what is this close
        query, row = np.nonzero((near >= least[:, None] - 2 * 10.0**-digits) & (near > -np.inf))
        similarity = np.round(near[query, row], digits) + 0.0
        order = np.lexsort((right[row], -similarity, query))
        query, row, similarity = query[order], row[order], similarity[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.k
        query, row, similarity, place = query[kept], row[kept], similarity[kept], place[kept]
        fresh = np.full_like(self.best, -np.inf)
        fresh[query, place] = similarity
        self.best = np.partition(np.concatenate([self.best, fresh], axis=1), self.k, axis=1)[:, self.k :]
        return query, row, similarity


def _best_in_blocks(asked: DataFrame, held: DataFrame, kind: str, k: int, dims: int, digits: int, bits: int = 0, share: float = 1.0) -> DataFrame:
    """Blocks of queries meet blocks of rows; k per query and block go on, and fewer where a task has seen better ones."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, last, block = _planes(dims, bits) if bits else None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                ask, own = batch.column("asked").slice(i, 1).flatten(), batch.column("held").slice(i, 1).flatten()
                q, v = batch.column("q")[i].as_py(), np.frombuffer(batch.column("v")[i].as_py(), np.float64).reshape(-1, dims)
                if q != last or not ask.equals(block.keys):
                    last, block = q, _Asked(ask, np.frombuffer(q, np.float64).reshape(-1, dims), k)
                buckets = batch.column("v_buckets")[i].as_py()
                near = block.near(v, None if buckets is None else np.frombuffer(buckets, np.int64), planes, share)
                query, row, similarity = block.select(near, np.array(own.to_pylist()), digits)
                if len(query):
                    yield pa.RecordBatch.from_arrays(
                        [ask.take(pa.array(query)), own.take(pa.array(row)), pa.array(similarity)], ["query", "key", "similarity"]
                    )

    # blocks, not rows; shuffled first, as every partition of the one side reads those of the other again
    met = asked.drop("q_buckets").hint("rebalance").crossJoin(held.hint("rebalance"))
    return best_of(met.mapInArrow(compare, f"query {kind}, key {kind}, similarity double"), k)


def indexed_neighbours(
    queries: DataFrame, rows: DataFrame, key: str, vector: str, k: int, dims: int, bits: int = 10, share: float = 0.65, digits: int = 6
) -> DataFrame:
    """(query, key, similarity, place): the best k of the rows in the buckets that a query looks into.

    Every row is in one bucket of random planes.  A query looks into the nearest ``share`` of all buckets, so the work is that share of
    the exact way's, in blocks too.  What lies in other buckets is missed; ``exact_neighbours`` misses nothing.
    Vectors without clusters need about this share for nine tenths of the neighbours, those with clusters less.
    """
    asked = _packed(directed(queries, key, vector, dims), QUERY_BLOCK, "asked", "q")
    held = _packed(bucketed(directed(rows, key, vector, dims), dims, bits), ROW_BLOCK, "held", "v")
    return _best_in_blocks(asked, held, queries.schema[key].dataType.simpleString(), k, dims, digits, bits, share)


def exact_neighbours(queries: DataFrame, rows: DataFrame, key: str, vector: str, k: int, dims: int, digits: int = 6) -> DataFrame:
    """(query, key, similarity, place): the best k of all rows."""
    asked = _packed(directed(queries, key, vector, dims), QUERY_BLOCK, "asked", "q")
    held = _packed(directed(rows, key, vector, dims), ROW_BLOCK, "held", "v")
    return _best_in_blocks(asked, held, queries.schema[key].dataType.simpleString(), k, dims, digits)


def recall(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row: queries, wanted neighbours, and how many of them were found."""
    hit = found.select("query", "key", F.lit(1).alias("hit"))
    return wanted.select("query", "key").join(hit, ["query", "key"], "left").agg(
        F.countDistinct("query").alias("queries"), F.count("*").alias("wanted"), F.count("hit").alias("found")
    )
