"""Scoring vectors against a query and embedding text with a given encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.arrays import cosine, cosine_to, doubles, norm
from .ranking import top_k


def score_against(vectors: DataFrame, vector: str, query: Sequence[float], out: str = "similarity") -> DataFrame:
    """Cosine similarity of every row to a query vector the caller holds."""
    return vectors.withColumn(out, cosine_to(F.col(vector), query))


def score_against_row(
    vectors: DataFrame, vector: str, query_row: DataFrame, query_vector: str, out: str = "similarity"
) -> DataFrame:
    """The same with the vector of a one-row table; it reaches the tasks as a single value."""
    v = doubles(F.col(query_vector))
    query = query_row.select(F.struct(v.alias("v"), norm(v).alias("n"))).scalar()
    asked = vectors.withColumn("_query", query)
    return asked.withColumn(out, cosine(F.col(vector), F.col("_query.v"), F.col("_query.n"))).drop("_query")


def most_similar(scored: DataFrame, key: str, k: int = 1, score: str = "similarity") -> DataFrame:
    return top_k(scored, k, score, [key])


def embed_text(df: DataFrame, text: str, make_encoder: Callable[[], Callable], out: str = "embedding") -> DataFrame:
    """Add a vector per text.

    ``make_encoder`` runs once per Python worker (load the model there) and returns a function
    from a list of texts to a list of vectors.  Whole texts are passed in, batch by batch.
    """

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder()
        for batch in batches:
            yield pd.Series([list(map(float, v)) for v in encoder(batch.fillna("").tolist())])

    return df.withColumn(out, encode(F.col(text)))
