"""Feature vectors and a classifier on labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.evaluation import binary_metrics
from ..operators.modelling import as_categories, fit_features, positive_probability, train_classifier, vector_entries
from ..operators.similarity import most_similar
from ..operators.terms import length, term_counts, term_rarity, term_weights, text_similarity
from .common import given, report
from .profiling import LABELLED_SQL, labelled

# Parameters of the registered queries.
CATEGORICAL = ["lang", "source"]
NUMERIC = ["n_chars"]
LABEL = "quality"
EVAL_SHARE = 5
SEARCH_TEXT = "the house of the ring and that thing in the land"
DIGITS = 6


def one_hot_features(spark, folder):
    rows = as_categories(labelled(spark, folder), CATEGORICAL)
    vectors = fit_features(rows, CATEGORICAL, NUMERIC).transform(rows)
    return report(vector_entries(vectors, ["doc_id"], "features"))


def _weights(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    counts = term_counts(documents, "doc_id", "text")
    rarity = term_rarity(counts, documents)
    return counts, rarity, term_weights(counts, rarity)


def text_vectors(spark, folder):
    """Number of different terms, length and largest weight of each document with terms."""
    _, _, weights = _weights(given(spark, folder, "documents").select("doc_id", "text"))
    vectors = weights.groupBy("doc_id").agg(
        F.count("*").alias("n_terms"),
        F.round(length(), DIGITS).alias("length"),
        F.round(F.max("weight"), DIGITS).alias("largest"),
    )
    return report(vectors)


def asked_weights(spark, text: str, rarity: DataFrame) -> DataFrame:
    asked = spark.range(1).select(F.lit(0).alias("asked"), F.lit(text).alias("text"))
    return term_weights(term_counts(asked, "asked", "text"), rarity, deal=False)


def most_similar_text(spark, folder):
    """The document closest to a search text: same weights for both, cosine, best one."""
    _, rarity, weights = _weights(given(spark, folder, "documents").select("doc_id", "text"))
    scored = text_similarity(weights, "doc_id", asked_weights(spark, SEARCH_TEXT, rarity))
    best = most_similar(scored.withColumn("similarity", F.round("similarity", DIGITS)), "doc_id")
    return report(best.select("doc_id", "similarity"))


def fold(key: Column, folds: int) -> Column:
    """A fold by the first hex digits of a hash, the same on any engine."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 4), 16, 10).cast("int") % folds


def classifier_split(spark, folder):
    """Rows and positive labels per fold; fold 0 is for evaluation."""
    rows = labelled(spark, folder).groupBy(fold(F.col("doc_id"), EVAL_SHARE).alias("fold"))
    return report(rows.agg(F.count("*").alias("n"), F.sum(LABEL).alias("positives")))


def text_shape(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, different, top): words, share of different ones, share of the most frequent one."""
    counts = term_counts(documents, "doc_id", "text")
    sums = counts.groupBy("doc_id").agg(F.sum("n").alias("n_words"), F.count("*").alias("_terms"), F.max("n").alias("_top"))
    return sums.select(
        "doc_id",
        F.col("n_words").cast("double").alias("n_words"),
        (F.col("_terms") / F.col("n_words")).alias("different"),
        (F.col("_top") / F.col("n_words")).alias("top"),
    )


TEXT_SHAPE = ["n_words", "different", "top"]


def classifier_rows(spark, folder) -> DataFrame:
    rows = as_categories(labelled(spark, folder), CATEGORICAL)
    texts = given(spark, folder, "documents").select("doc_id", "text").join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    shaped = rows.join(text_shape(texts), "doc_id", "left").fillna(0.0, TEXT_SHAPE)
    return shaped.withColumn("_fold", fold(F.col("doc_id"), EVAL_SHARE))


def train_eval_classifier(spark, folder):
    """Train on four fifths of the labelled documents, evaluate on the rest."""
    rows = classifier_rows(spark, folder)
    numeric = [*NUMERIC, *TEXT_SHAPE]
    model = train_classifier(rows.filter("_fold <> 0"), LABEL, CATEGORICAL, numeric)
    scored = positive_probability(model.transform(rows.filter("_fold = 0"))).select(LABEL, "p")
    return report(binary_metrics(scored, LABEL, "p"))


QUERIES = {f.__name__: f for f in (one_hot_features, text_vectors, most_similar_text, classifier_split, train_eval_classifier)}

# A pattern may not hold braces in a format string.
WORD_SQL = r"[\p{L}\p{N}]+"
TERMS_SQL = f"""words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD_SQL}')) AS term FROM documents),
counts AS (SELECT doc_id, term, COUNT(*) AS n FROM words GROUP BY doc_id, term),
rarity AS (SELECT term, LN((SELECT COUNT(*) + 1 FROM documents) / (COUNT(*) + 1)) AS rarity FROM counts GROUP BY term),
weights AS (SELECT doc_id, term, n * rarity AS weight FROM counts JOIN rarity USING (term))"""

ORACLES = {
    "text_vectors": f"""WITH {TERMS_SQL}
SELECT doc_id, COUNT(*) AS n_terms, ROUND(SQRT(SUM(weight * weight)), {DIGITS}) AS length, ROUND(MAX(weight), {DIGITS}) AS largest
FROM weights GROUP BY doc_id""",
    "most_similar_text": f"""WITH {TERMS_SQL},
asked AS (SELECT term, n * rarity AS a FROM (SELECT term, COUNT(*) AS n
  FROM (SELECT unnest(regexp_extract_all(lower('{SEARCH_TEXT}'), '{WORD_SQL}')) AS term) AS t GROUP BY term) AS q JOIN rarity USING (term)),
scored AS (SELECT doc_id, SUM(weight * a) / (SQRT(SUM(weight * weight)) * (SELECT SQRT(SUM(a * a)) FROM asked)) AS s
  FROM weights LEFT JOIN asked USING (term) GROUP BY doc_id)
SELECT doc_id, ROUND(COALESCE(s, 0), {DIGITS}) AS similarity FROM scored ORDER BY 2 DESC, doc_id LIMIT 1""",
    "classifier_split": f"""WITH {LABELLED_SQL}
SELECT CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 4) AS BIGINT) % {EVAL_SHARE} AS fold, COUNT(*) AS n,
  CAST(SUM({LABEL}) AS BIGINT) AS positives FROM labelled GROUP BY 1""",
    "one_hot_features": f"""WITH {LABELLED_SQL},
langs AS (SELECT lang, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, lang) - 1 AS place FROM labelled GROUP BY lang),
sources AS (SELECT source, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, source) - 1 AS place FROM labelled GROUP BY source),
sizes AS (SELECT (SELECT COUNT(*) + 1 FROM langs) AS a, (SELECT COUNT(*) + 1 FROM sources) AS b)
SELECT doc_id, place AS position, CAST(1 AS DOUBLE) AS value FROM labelled JOIN langs USING (lang)
UNION ALL
SELECT doc_id, a + place, 1 FROM labelled JOIN sources USING (source), sizes
UNION ALL
SELECT doc_id, a + b, CAST(n_chars AS DOUBLE) FROM labelled, sizes WHERE n_chars <> 0""",
}
