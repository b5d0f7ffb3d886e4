"""Column profiles of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.evaluation import binary_metrics, shuffled_batches as batches
from ..operators.profile import describe, histogram, label_rate, value_counts as counts
from .common import given, report

# Parameters of the registered queries.
DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
BINS = 20
SEED = 7
BATCH = 32
TYPICAL_LENGTH = 1500
DIGITS = 6


def labelled(spark, folder) -> DataFrame:
    """Labelled documents with their attributes, without the text."""
    documents = given(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return given(spark, folder, "labels").join(documents, "doc_id")


def describe_numeric(spark, folder):
    out = describe(given(spark, folder, "lineitem"), DESCRIBED)
    numbers = [F.round(F.col(c), DIGITS).alias(c) for c in out.columns[2:]]
    return report(out.select("column_name", "n", *numbers))


def value_counts(spark, folder):
    return report(counts(given(spark, folder, "documents"), "source"))


def histogram20(spark, folder):
    out = histogram(given(spark, folder, "lineitem"), "l_extendedprice", BINS)
    return report(out.select("bin", F.round("bin_from", 4).alias("bin_from"), F.round("bin_to", 4).alias("bin_to"), "n"))


def label_rate_by_group(spark, folder):
    out = label_rate(labelled(spark, folder), "lang", "quality")
    return report(out.select("lang", F.round("rate", DIGITS).alias("rate")))


def shuffled_batches(spark, folder):
    placed = batches(given(spark, folder, "labels").select("doc_id"), "doc_id", SEED, BATCH)
    return report(placed.select("doc_id", "position", "batch"))


def binary_evaluation(spark, folder):
    """How well the length of a document tells its quality."""
    length = F.col("n_chars").cast("double")
    scored = labelled(spark, folder).withColumn("p", length / (length + TYPICAL_LENGTH))
    out = binary_metrics(scored, "quality", "p")
    return report(out.select("n", *[F.round(F.col(c), DIGITS).alias(c) for c in out.columns[1:]]))


QUERIES = {
    f.__name__: f
    for f in (
        describe_numeric, value_counts, histogram20, label_rate_by_group, shuffled_batches, binary_evaluation,
    )
}

_DESCRIBE_SQL = """SELECT '{c}' AS column_name, COUNT({c}) AS n, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std,
  ROUND(MIN({c}), 6) AS min, ROUND(QUANTILE_CONT({c}, 0.25), 6) AS q25, ROUND(QUANTILE_CONT({c}, 0.5), 6) AS q50,
  ROUND(QUANTILE_CONT({c}, 0.75), 6) AS q75, ROUND(MAX({c}), 6) AS max FROM lineitem"""
LABELLED_SQL = "labelled AS (SELECT l.*, d.lang, d.source, d.n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"

ORACLES = {
    "describe_numeric": "\nUNION ALL\n".join(_DESCRIBE_SQL.format(c=c) for c in DESCRIBED),
    "value_counts": "SELECT source, COUNT(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source",
    "histogram20": f"""WITH edges AS (SELECT MIN(l_extendedprice) AS low, MAX(l_extendedprice) AS high FROM lineitem),
binned AS (SELECT LEAST(CAST(FLOOR((l_extendedprice - low) / (high - low) * {BINS}) AS BIGINT), {BINS - 1}) AS bin
           FROM lineitem, edges WHERE l_extendedprice IS NOT NULL),
counted AS (SELECT bin, COUNT(*) AS n FROM binned GROUP BY bin)
SELECT b.bin, ROUND(low + b.bin * ((high - low) / {BINS}), 4) AS bin_from,
       ROUND(low + (b.bin + 1) * ((high - low) / {BINS}), 4) AS bin_to, COALESCE(n, 0) AS n
FROM (SELECT UNNEST(range({BINS})) AS bin) b CROSS JOIN edges LEFT JOIN counted c ON b.bin = c.bin""",
    "label_rate_by_group": f"WITH {LABELLED_SQL} SELECT lang, ROUND(AVG(quality), 6) AS rate FROM labelled GROUP BY lang",
    "shuffled_batches": f"""WITH placed AS (
  SELECT doc_id, ROW_NUMBER() OVER (ORDER BY md5(doc_id || ':{SEED}'), doc_id) AS position FROM labels)
SELECT doc_id, position, (position - 1) // {BATCH} AS batch FROM placed""",
    "binary_evaluation": f"""WITH {LABELLED_SQL},
scored AS (SELECT quality, CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + {TYPICAL_LENGTH}) AS p FROM labelled),
clipped AS (SELECT *, LEAST(GREATEST(p, 1e-7), 1 - 1e-7) AS c FROM scored),
ranked AS (SELECT quality, (RANK() OVER (ORDER BY p) + RANK() OVER (ORDER BY p) + COUNT(*) OVER (PARTITION BY p) - 1) / 2 AS r FROM scored),
auc AS (SELECT (SUM(CASE WHEN quality = 1 THEN r END) - SUM(quality) * (SUM(quality) + 1) / 2)
               / (SUM(quality) * CAST(SUM(1 - quality) AS DOUBLE)) AS auc FROM ranked)
SELECT COUNT(*) AS n, ROUND(AVG(CASE WHEN quality = 1 THEN -LN(c) ELSE -LN(1 - c) END), 6) AS loss,
       ROUND(AVG(CASE WHEN (p > 0.5) = (quality = 1) THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS accuracy,
       ROUND(COUNT(*) FILTER (p > 0.5 AND quality = 1) / COUNT(*) FILTER (p > 0.5), 6) AS precision,
       ROUND(COUNT(*) FILTER (p > 0.5 AND quality = 1) / COUNT(*) FILTER (quality = 1), 6) AS recall,
       (SELECT ROUND(auc, 6) FROM auc) AS auc
FROM clipped""",
}
