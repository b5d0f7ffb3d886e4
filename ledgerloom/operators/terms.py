"""Texts as weighted terms: a row per document and different term, no fixed number of slots.

Terms are runs of letters and digits in lower case.  A term's weight is its count in the document
times ln((N + 1) / (n + 1)), with n of the N documents holding it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A term in more than one in so many documents is common; so there are fewer than that many times the mean number of terms of a document.
COMMON = 1024
TERM = r"([\p{L}\p{N}]+)"


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), 1)


def term_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, n).  The terms of a row move as one list, to where the rows of its key are counted."""
    listed = df.select(key, terms_of(F.col(text)).alias("_terms")).repartition(key)
    terms = listed.select(key, F.explode("_terms").alias("term"))
    return terms.filter("term IS NOT NULL").groupBy(key, "term").agg(F.count("*").alias("n"))


def term_rarity(counts: DataFrame, documents: DataFrame) -> DataFrame:
    """(term, rarity, common); ``documents`` is the whole table, as some may hold no term."""
    total = documents.select(F.count("*").alias("n")).scalar()
    holding = counts.groupBy("term").agg(F.count("*").alias("holding"))
    return holding.select("term", F.ln((total + 1) / (F.col("holding") + 1)).alias("rarity"), (F.col("holding") * COMMON > total).alias("common"))


def term_weights(counts: DataFrame, rarity: DataFrame, deal: bool = True) -> DataFrame:
    """(..., term, weight) of the terms that ``rarity`` knows.

    With ``deal`` the common terms are broadcast, so that their rows stay with those of their document; only rows of the
    others meet their rarity in a shuffle.
    """
    if not deal:
        joined = counts.join(rarity.drop("common"), "term")
    else:
        few = F.broadcast(rarity.filter("common").select("term", "rarity"))
        met = counts.join(few, "term", "left")
        others = met.filter("rarity IS NULL").drop("rarity").join(rarity.filter("NOT common").drop("common"), "term")
        joined = met.filter("rarity IS NOT NULL").unionByName(others)
    return joined.withColumn("weight", F.col("n") * F.col("rarity")).drop("n", "rarity")


def length(weight: str = "weight") -> Column:
    return F.sqrt(F.sum(F.col(weight) * F.col(weight)))


def text_similarity(weights: DataFrame, key: str, asked: DataFrame) -> DataFrame:
    """(key, similarity): cosine of documents with the weighted terms of one search text; 0 without a common term.

    Only the search text's terms are looked up; a document is down to one row before anything meets.
    """
    wanted = asked.select("term", F.col("weight").alias("_asked"))
    joined = weights.join(F.broadcast(wanted), "term", "left")
    sums = joined.groupBy(key).agg(length().alias("_length"), F.sum(F.col("weight") * F.col("_asked")).alias("_dot"))
    asked_length = asked.select(length().alias("l")).scalar()
    both = F.col("_length") * asked_length
    return sums.select(key, F.coalesce(F.col("_dot") / F.nullif(both, F.lit(0.0)), F.lit(0.0)).alias("similarity"))
