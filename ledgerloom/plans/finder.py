"""Search as one job: filter dated entries, find the one most like a text, list its links, say if nothing was found.

An event stands for an entry, the document of its number for the entry's text, and a page for its links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import filled_links
from ..operators.similarity import most_similar
from ..operators.terms import term_counts, term_rarity, term_weights, text_similarity
from .almanac import EVENT_TYPE, FIRST_YEAR, ITEMS_SQL, LAST_YEAR, entry_table, search_times
from .common import given, report
from .learning import DIGITS, SEARCH_TEXT, WORD_SQL, asked_weights

# Parameters of the registered query: the second range goes over New Year, so nothing lies in it.
RANGES = {"January": ("January 1", "January 31"), "New Year": ("December 20", "January 10")}
NOTHING = "(nothing found)"


def best_entry(spark, texts: DataFrame, text: str) -> DataFrame:
    """(doc_id, similarity) of the text most like the asked one, by weights among these texts; no row for no texts."""
    counts = term_counts(texts, "doc_id", "text")
    rarity = term_rarity(counts, texts)
    scored = text_similarity(term_weights(counts, rarity), "doc_id", asked_weights(spark, text, rarity))
    return most_similar(scored.withColumn("similarity", F.round("similarity", DIGITS)), "doc_id")


def filtered_text_search(spark, folder):
    """Per range of days: the best entry with its links, or one row that says that there is none."""
    documents = given(spark, folder, "documents").select("doc_id", "text")
    pages = given(spark, folder, "pages").select(F.count("*").alias("n")).scalar()
    links = entry_table(spark, folder).select(
        F.col("page_id").alias("page"), F.col("item_no").alias("item_no"), F.explode(filled_links(F.col("links"))).alias("l")
    )
    found = []
    for name, (first, last) in RANGES.items():
        events = search_times(given(spark, folder, "events"), first, last, FIRST_YEAR, LAST_YEAR, EVENT_TYPE)
        texts = documents.join(events.select(F.col("event_id").alias("doc_id")), "doc_id", "left_semi")
        best = best_entry(spark, texts, SEARCH_TEXT).withColumn("page", F.col("doc_id") % F.nullif(pages, F.lit(0)))
        linked = best.join(links, "page", "left").select("doc_id", "similarity", "item_no", "l.tag", "l.link")
        # one asked range, with or without an answer
        asked = spark.range(1).select(F.lit(name).alias("asked"), F.lit(1).alias("_one"))
        answer = asked.join(linked.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")
        note = F.when(F.col("doc_id").isNull(), NOTHING).alias("note")
        found.append(answer.select("asked", "doc_id", "similarity", "item_no", "tag", "link", note))
    return report(found[0].unionByName(found[1]))


QUERIES = {"filtered_text_search": filtered_text_search}


def _range_sql(name: str, first: str, last: str) -> str:
    return f"""
SELECT '{name}' AS asked, event_id AS doc_id, text FROM events JOIN documents ON doc_id = event_id
WHERE event_type = '{EVENT_TYPE}' AND YEAR(ts) BETWEEN {FIRST_YEAR} AND {LAST_YEAR}
AND strftime(ts, '%m%d') BETWEEN strftime(strptime('2000 {first}', '%Y %B %d'), '%m%d') AND strftime(strptime('2000 {last}', '%Y %B %d'), '%m%d')"""


ORACLES = {
    "filtered_text_search": f"""WITH {ITEMS_SQL},
texts AS ({" UNION ALL ".join(_range_sql(k, *v) for k, v in RANGES.items())}),
counts AS (SELECT asked, doc_id, term, COUNT(*) AS n
  FROM (SELECT asked, doc_id, unnest(regexp_extract_all(lower(text), '{WORD_SQL}')) AS term FROM texts) AS t GROUP BY ALL),
rarity AS (SELECT asked, term, LN(((SELECT COUNT(*) FROM texts AS x WHERE x.asked = c.asked) + 1) / (COUNT(*) + 1)) AS rarity
  FROM counts AS c GROUP BY asked, term),
query AS (SELECT asked, term, n * rarity AS a FROM (SELECT term, COUNT(*) AS n
  FROM (SELECT unnest(regexp_extract_all(lower('{SEARCH_TEXT}'), '{WORD_SQL}')) AS term) AS t GROUP BY term) AS q JOIN rarity USING (term)),
lengths AS (SELECT asked, SQRT(SUM(a * a)) AS l FROM query GROUP BY asked),
weights AS (SELECT c.asked, doc_id, c.term, n * rarity AS w FROM counts AS c JOIN rarity AS r ON r.asked = c.asked AND r.term = c.term),
scored AS (SELECT w.asked, doc_id, ROUND(COALESCE(SUM(w * a) / (SQRT(SUM(w * w)) * MAX(l)), 0), {DIGITS}) AS similarity
  FROM weights AS w LEFT JOIN query AS q ON q.asked = w.asked AND q.term = w.term LEFT JOIN lengths AS x ON x.asked = w.asked GROUP BY w.asked, doc_id),
best AS (SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (PARTITION BY asked ORDER BY similarity DESC, doc_id) = 1),
ranges AS (SELECT unnest([{', '.join(repr(k) for k in RANGES)}]) AS asked)
SELECT r.asked, doc_id, similarity, item_no, tag, link, CASE WHEN doc_id IS NULL THEN '{NOTHING}' END AS note
FROM ranges AS r LEFT JOIN best AS b ON b.asked = r.asked
LEFT JOIN (SELECT * FROM items WHERE linked) AS i ON i.page_id = doc_id % (SELECT COUNT(*) FROM pages)""",
}
