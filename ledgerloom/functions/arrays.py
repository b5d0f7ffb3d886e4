"""Vector expressions on ``array<double>`` columns.

A lambda body is evaluated again for every element, so anything computed once per row
(a maximum, a norm, a cast) is bound first with :func:`let`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

# Fixed bounds for probabilities before taking logarithms.
CLIP_LOW = 1e-7
CLIP_HIGH = 1 - 1e-7


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def doubles(x: Column) -> Column:
    return x.cast("array<double>")


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)


def mean(x: Column) -> Column:
    return F.try_divide(total(x), F.size(x))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda v: v * v)))


def cosine(a: Column, b: Column, b_norm: Column | None = None) -> Column:
    """Cosine similarity; 0 where a vector has no length."""

    def score(x: Column) -> Column:
        lengths = norm(x) * (norm(b) if b_norm is None else b_norm)
        return let(lengths, lambda n: F.when(n == 0, F.lit(0.0)).otherwise(dot(x, b) / n))

    return let(doubles(a), score)


def literal_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def cosine_to(a: Column, query: Sequence[float]) -> Column:
    """Cosine similarity to a vector known to the caller; its norm is taken once."""
    length = math.sqrt(sum(float(v) ** 2 for v in query))
    return cosine(a, literal_vector(query), F.lit(length))


def dense(x: Column, weights: Sequence[Sequence[float]], biases: Sequence[float]) -> Column:
    """One dense layer: for each neuron the dot product with its weights plus its bias."""
    if len(weights) != len(biases):
        raise ValueError("one bias per neuron is needed")
    neurons = F.array(
        *[F.struct(literal_vector(w).alias("w"), F.lit(float(b)).alias("b")) for w, b in zip(weights, biases)]
    )
    return let(doubles(x), lambda v: F.transform(neurons, lambda n: dot(v, n["w"]) + n["b"]))


def step(x: Column) -> Column:
    return F.transform(x, lambda v: F.when(v > 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def sigmoid(x: Column) -> Column:
    return F.transform(x, lambda v: 1 / (1 + F.exp(-v)))


def relu(x: Column) -> Column:
    return F.transform(x, lambda v: F.greatest(F.lit(0.0), v))


def exponentials(x: Column) -> Column:
    return F.transform(x, lambda v: F.exp(v))


def normalised(x: Column) -> Column:
    """Each element as a share of the array's sum; null where that is 0."""
    return let(total(x), lambda s: F.transform(x, lambda v: F.try_divide(v, s)))


def softmax(x: Column) -> Column:
    """Probabilities from scores; the largest score is subtracted first against overflow."""
    shifted = let(F.array_max(x), lambda top: F.transform(x, lambda v: F.exp(v - top)))
    return let(shifted, normalised)


def clipped(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(CLIP_LOW)), F.lit(CLIP_HIGH))


def cross_entropy(probabilities: Column, target: Column) -> Column:
    """Loss against a class number counted from 0."""
    return -F.ln(clipped(F.get(probabilities, target.cast("int"))))


def cross_entropy_one_hot(probabilities: Column, target: Column) -> Column:
    """Loss against a one-hot array."""
    return -F.ln(dot(F.transform(probabilities, clipped), target))


def argmax(x: Column) -> Column:
    """Position of the first largest element, counted from 0."""
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def top_classes(scores: Column, k: int) -> Column:
    """The ``k`` best classes as ``array<struct<score, class>>``, best first.

    Equal scores go by class number.
    """
    tagged = F.transform(scores, lambda s, i: F.struct((-s).alias("order"), i.alias("class"), s.alias("score")))
    best = F.slice(F.array_sort(tagged), 1, k)
    return F.transform(best, lambda t: F.struct(t["class"].alias("class"), t["score"].alias("score")))


def grid(start: float, stop: float, points: int) -> Column:
    """Evenly spaced values from ``start`` to ``stop``, both included."""
    if points == 1:
        return literal_vector([start])
    width = (stop - start) / (points - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.lit(float(start)) + i * F.lit(width))
