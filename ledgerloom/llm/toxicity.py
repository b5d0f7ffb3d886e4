"""Toxicity by a bag of subword embeddings averaged into a linear softmax, trained jointly in numpy.

A window of words is the bag of the character n-grams of its words and of the words themselves, hashed into
buckets that each have an embedding.  The mean embedding goes through a linear softmax.  A misspelt word
shares most n-grams with the right one, so it scores near it without having been seen.  A document's
score is that of its worst window, in training too: after some epochs that tell which subwords are
suspect at all, the gradient of a document goes to its worst windows, so a few words in a long text count.
Embeddings start near zero, so subwords that were never seen say nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .hashing import NO_WORD, Words, blocks, mix, text_bytes
from .storage import id_bucket

BUCKET_BITS = 18
SIZES = (3, 4, 5)
DIMENSIONS = 8
WINDOW = 8
#: From this score on a text is taken as toxic.
THRESHOLD = 0.3
#: Bounds of the sample that one task trains on: labelled rows of each class, chosen by a hash, and characters of all their texts.
TOXIC_ROWS, CLEAN_ROWS = 800, 1200
SAMPLE_BYTES = 64 << 20
EPOCHS = 30
#: Epochs in which a toxic document trains many of its windows, from half of them down to the worst; and worst windows of a clean one.
WARM, CLEAN_WINDOWS = 6, 4
BLOCK = 1 << 19


class Bags:
    """Subwords of documents: bucket and byte place, and where the windows start."""

    def __init__(self):
        self.words = Words(NO_WORD)

    def _cut(self, text: np.ndarray) -> tuple[np.ndarray, ...]:
        w, size = self.words, len(text)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(w.byte[text] * w.power[:size], out=sums[1:])
        starts, ends = w.spans(text, np.array([0, size]))
        return sums, starts, ends, mix((sums[ends] - sums[starts]) * w.inverse[starts] + np.uint64(99))

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray, int]:
        """Pairs (buckets, places) for each kind of subword; window starts; the windows' document; length of the text used."""
        w, n = self.words, len(offsets) - 1
        lengths = np.diff(offsets)
        size = int(lengths.sum()) + n + 1
        text = np.full(size, 0x20, np.uint8)
        inner = np.arange(size - n - 1) + np.repeat(np.arange(1, n + 1), lengths)
        source = data[offsets[0] : offsets[-1]]
        text[inner] = np.where(w.cut[source], np.uint8(0x20), w.lower[source])
        if size >= len(w.power):
            w._powers(size)
        edge = np.cumsum(np.concatenate([[0], lengths + 1]))
        sums, starts, ends, whole = self._cut(text)
        again = np.flatnonzero((whole[1:] == whole[:-1]) & (np.searchsorted(edge, starts[1:]) == np.searchsorted(edge, starts[:-1]))) + 1
        if len(again):  # a word that repeats the one before it counts once
            gone = np.zeros(size + 1, np.int32)
            gone[starts[again]] += 1
            gone[ends[again]] -= 1
            text[np.cumsum(gone[:-1]) > 0] = 0x20
            sums, starts, ends, whole = self._cut(text)
        before = np.concatenate([[0], np.cumsum(text == 0x20, dtype=np.int32)])
        out = []
        for k in SIZES:
            if size < k:
                continue
            start = np.flatnonzero(before[k - 1 : size] == before[1 : size - k + 2])  # no blank inside
            grams = mix((sums[start + k] - sums[start]) * w.inverse[start] + np.uint64(k))
            out.append(((grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), start + 1))
        out.append(((whole >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), starts))
        doc = np.searchsorted(edge, starts, "right") - 1
        bounds = np.searchsorted(starts, edge)
        nth = np.arange(len(starts)) - bounds[doc]
        left = bounds[doc + 1] - bounds[doc] - nth
        heads = np.flatnonzero((nth % WINDOW == 0) & ((nth == 0) | (left * 2 >= WINDOW)))  # a short rest joins the window before it
        return out, starts[heads], doc[heads], size


@dataclass
class Model:
    weight: np.ndarray  # what a bucket adds to the log odds of its window's mean
    bias: float

    def scores(self, bags: Bags, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        kinds, starts, doc, size = bags.of(data, offsets)
        n = len(offsets) - 1
        result = np.zeros(n)
        if not len(starts):
            return result
        total, count = np.zeros(size + 1), np.zeros(size + 1)
        for buckets, places in kinds:
            total += np.bincount(places, self.weight[buckets], size + 1)
            count += np.bincount(places, minlength=size + 1)
        logits = np.add.reduceat(total, starts) / np.maximum(np.add.reduceat(count, starts), 1) + self.bias
        has, where = np.unique(doc, return_index=True)
        result[has] = 1 / (1 + np.exp(-np.clip(np.maximum.reduceat(logits, where), -500, 500)))
        return result


def train(texts: list[str], toxic: np.ndarray, seed: int = 3) -> Model:
    """Joint training of embeddings and softmax by Adagrad on the worst windows of each document."""
    bags, rng = Bags(), np.random.default_rng(seed)
    ids, window_size, owner = [], [], []
    column = pa.array(texts, pa.string())
    data, offsets = text_bytes(column)
    for first, last in blocks(offsets, BLOCK):
        kinds, starts, doc, _ = bags.of(data, offsets[first : last + 1])
        if not len(starts):
            continue
        buckets = np.concatenate([b for b, _ in kinds])
        window = np.searchsorted(starts, np.concatenate([p for _, p in kinds]), "right") - 1
        ids.append(buckets[np.argsort(window, kind="stable")])
        window_size.append(np.bincount(window, minlength=len(starts)))
        owner.append(doc + first)
    buckets = 1 << BUCKET_BITS
    if not ids or len(np.unique(toxic)) < 2:
        rate = float(np.clip(np.mean(toxic), 0.01, 0.99)) if len(toxic) else 0.01
        return Model(np.zeros(buckets), float(np.log(rate / (1 - rate))))
    flat, sizes, doc = np.concatenate(ids), np.concatenate(window_size), np.concatenate(owner)
    at = np.concatenate([[0], np.cumsum(sizes)])
    has, where = np.unique(doc, return_index=True)
    ends = np.concatenate([where[1:], [len(doc)]])
    embed = rng.normal(0, 0.001, (buckets, DIMENSIONS)).astype(np.float32)
    soft = rng.normal(0, 0.5, (2, DIMENSIONS)).astype(np.float32)
    bias = np.zeros(2)
    embed_sq, soft_sq, bias_sq = np.full(buckets, 1e-4, np.float32), np.full((2, DIMENSIONS), 1e-4), np.full(2, 1e-4)
    for epoch in range(EPOCHS):
        weight = embed @ (soft[1] - soft[0])
        means = np.concatenate(
            [np.add.reduceat(weight[flat[at[i] : at[j]]], at[i:j] - at[i]) for i, j in _runs(len(sizes), 100_000)]
        ) / sizes
        chosen, label = [], []
        for k, d in enumerate(has):
            own = means[where[k] : ends[k]]
            many = max(1, int(len(own) * 0.5 * (1 - epoch / WARM))) if toxic[d] else CLEAN_WINDOWS
            best = np.argpartition(own, -many)[-many:] if len(own) > many else np.arange(len(own))
            if not toxic[d]:
                best = np.append(best, rng.integers(len(own)))
            chosen.extend(where[k] + best)
            label.extend([int(toxic[d])] * len(best))
        chosen, label = np.array(chosen), np.array(label)
        order = rng.permutation(len(chosen))
        for batch in np.array_split(order, max(1, len(order) // 32)):
            _step(flat, at, sizes, chosen[batch], label[batch], embed, soft, bias, embed_sq, soft_sq, bias_sq)
    return Model((embed @ (soft[1] - soft[0])).astype(np.float64), float(bias[1] - bias[0]))


def _runs(n: int, size: int) -> list[tuple[int, int]]:
    return [(i, min(n, i + size)) for i in range(0, n, size)]


def _step(flat, at, sizes, windows, label, embed, soft, bias, embed_sq, soft_sq, bias_sq, rate=0.1) -> None:
    length = sizes[windows]
    rows = np.concatenate([flat[at[w] : at[w + 1]] for w in windows])
    owner = np.repeat(np.arange(len(windows)), length)
    mean = np.add.reduceat(embed[rows], np.concatenate([[0], np.cumsum(length)[:-1]])) / length[:, None]
    logits = mean @ soft.T + bias
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(label)), label] -= 1
    error = p / len(label)
    down = (error @ soft) / length[:, None]
    unique, inverse = np.unique(rows, return_inverse=True)
    grad = np.stack([np.bincount(inverse, down[owner, k], len(unique)) for k in range(DIMENSIONS)], axis=1)
    embed_sq[unique] += (grad**2).mean(axis=1)
    embed[unique] -= (rate * grad / np.sqrt(embed_sq[unique])[:, None]).astype(np.float32)
    soft_grad = error.T @ mean
    soft_sq += soft_grad**2
    soft -= (rate * soft_grad / np.sqrt(soft_sq)).astype(np.float32)
    bias_grad = error.sum(axis=0)
    bias_sq += bias_grad**2
    bias -= rate * bias_grad / np.sqrt(bias_sq)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(toxic, id, text): at most TOXIC_ROWS and CLEAN_ROWS labelled texts, the first by a hash of their id."""
    parts = []
    marked = labels.filter("toxic IS NOT NULL").select(F.col("doc_id").alias("id"), "toxic")
    for value, rows in ((1, TOXIC_ROWS), (0, CLEAN_ROWS)):
        # the ids are chosen without the texts; only those rows meet the documents
        order = F.xxhash64(F.lit("toxicity"), F.col("id"))
        ids = marked.filter(F.col("toxic") == value).select("id", order.alias("_h")).distinct().orderBy("_h", "id").limit(rows)
        found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids.select("id")), "id")
        parts.append(found.orderBy("id", "text").limit(rows).select(F.lit(value).alias("toxic"), "id", F.coalesce("text", F.lit("")).alias("text")))
    return parts[0].unionByName(parts[1])


def fitted(rows: DataFrame) -> Model:
    """The model of a bounded sample (toxic, id, text), trained in one task, so that the driver holds no texts.

    Texts that would take the sample over SAMPLE_BYTES are passed over.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic, size = [], [], 0
        for batch in batches:
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                if size + len(text) <= SAMPLE_BYTES:
                    texts.append(text)
                    toxic.append(label)
                    size += len(text)
        model = train(texts, np.array(toxic, int))
        yield pa.RecordBatch.from_pydict({"weight": pa.array([model.weight.tobytes()], pa.binary()), "bias": [model.bias]})

    ordered = rows.repartition(1).sortWithinPartitions(F.desc("toxic"), "id", "text").select("toxic", "text")
    row = ordered.mapInArrow(fit, "weight binary, bias double").first()
    return Model(np.frombuffer(row.weight, np.float64), row.bias) if row else train([], np.array([], int))


def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; null, empty and wordless texts score 0.  Ids may be null or repeat."""
    # plain arrays: a broadcast object of this package would be looked for on the executors
    shipped = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))  # 2 ** BUCKET_BITS numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, own = Bags(), Model(*shipped.value)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in blocks(offsets, BLOCK):
                scores = own.scores(bags, data, offsets[first : last + 1])
                yield pa.RecordBatch.from_pydict({id_col: batch.column("id").slice(first, last - first), "score": scores})

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(score, f"`{id_col}` long, score double")


def toxicity_score(spark: SparkSession, text: Column, model: Model) -> Column:
    """The score of each row's text as a column, so that whole rows need no key to meet their score again."""
    shipped = spark.sparkContext.broadcast((model.weight, model.bias))

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bags, own = Bags(), Model(*shipped.value)
        for column in texts:
            data, offsets = text_bytes(column)
            parts = [own.scores(bags, data, offsets[first : last + 1]) for first, last in blocks(offsets, BLOCK)]
            yield pa.array(np.concatenate([np.empty(0), *parts]))

    return score(text)


def toxicity_model(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of the labelled rows whose crc32 of the id modulo ``folds`` is not ``held_out``."""
    learn = labels.filter(id_bucket(F.col("doc_id"), folds) != held_out)
    return fitted(sample(docs, learn, id_col, text_col))


def toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = 4, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    Learns from labelled rows whose crc32 of the id modulo ``folds`` is not ``held_out``; only the text is
    scored.  Without labels of both classes every text gets the share of toxic labels.  A word that repeats the one
    before it counts once.  Null, empty and wordless texts score 0; texts of any length are read whole.  Rows that
    repeat are scored alike, rows with a null id are scored too.  Other columns are not read.  An empty table gives no rows.
    """
    model = toxicity_model(docs, labels, folds, held_out, id_col, text_col)
    scored = toxicity_scores(docs, model, id_col, text_col)
    return scored.select(
        id_col, (id_bucket(F.col(id_col), folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
