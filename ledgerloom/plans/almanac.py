"""Dated entries: pages to entries and links, signed years, search by month-day and year."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import (
    days_in_month, in_year, month_day_as_date, month_day_name, month_day_number, month_day_of_page, page_name,
)
from ..functions.text import (
    MAX_LINKS, blank_own_date, entry_body, filled_links, link_slots as slots, signed_year, strip_citations, url_tag,
)
from ..sources.calendar import month_days
from ..sources.html import entries, page_items
from .common import given, report

# Parameters of the registered search.
FIRST_DAY, LAST_DAY = "January 5", "January 20"
FIRST_YEAR, LAST_YEAR = 1900, 2024
EVENT_TYPE = "view"
NO_DAY = "(not in calendar)"


def search(entries: DataFrame, first_day: str, last_day: str, first_year: int, last_year: int, event_type: str) -> DataFrame:
    """Entries (date, year, event_type) between two month-days and two years.  A range over New Year finds nothing."""
    day = month_day_as_date(F.col("date"))
    first, last = month_day_as_date(F.lit(first_day)), month_day_as_date(F.lit(last_day))
    return entries.filter(
        (F.col("event_type") == event_type)
        & F.col("year").between(first_year, last_year)
        & day.between(first, last)
    )


def search_times(events: DataFrame, first_day: str, last_day: str, first_year: int, last_year: int, event_type: str) -> DataFrame:
    """The same for events with a timestamp ``ts``.

    The years are a range of the stored time, which the scan can use; the day is compared as a number.
    """
    first, last = (month_day_number(month_day_as_date(F.lit(d))) for d in (first_day, last_day))
    return events.filter(
        (F.col("event_type") == event_type)
        & in_year("ts", first_year, last_year)
        & month_day_number(F.col("ts")).between(first, last)
    )


def dated_events(spark, folder) -> DataFrame:
    return as_entries(given(spark, folder, "events"))


def as_entries(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("id"),
        month_day_name(F.col("ts")).alias("date"),
        F.year("ts").alias("year"),
        "event_type",
        F.col("props").alias("text"),
    )


def month_day_year_search(spark, folder):
    found = search_times(given(spark, folder, "events"), FIRST_DAY, LAST_DAY, FIRST_YEAR, LAST_YEAR, EVENT_TYPE)
    return report(as_entries(found))


def valid_month_days(spark, folder):
    """Every day of the calendar with its number of events, and one row for events on no day of it (29 February)."""
    counted = dated_events(spark, folder).groupBy(F.col("date").alias("month_day")).agg(F.count("*").alias("n"))
    calendar = month_days(spark)
    days = calendar.join(counted, "month_day", "left").select("day_of_year", "month_day", "n")
    others = counted.join(calendar, "month_day", "left_anti").agg(F.sum("n").alias("n"))
    others = others.select(F.lit(None).cast("int").alias("day_of_year"), F.lit(NO_DAY).alias("month_day"), "n")
    return report(days.unionByName(others).select("day_of_year", "month_day", F.coalesce("n", F.lit(0)).alias("events")))


def calendar_pages(spark, folder):
    """Events per month-day, with the name of its page, the name read back from that, and the days of its month."""
    counted = given(spark, folder, "events").groupBy(month_day_name(F.col("ts")).alias("month_day")).agg(F.count("*").alias("events"))
    month = F.split_part(F.col("month_day"), F.lit(" "), F.lit(1))
    return report(
        counted.withColumn("page", page_name(F.col("month_day"))).select(
            "month_day", "page", month_day_of_page(F.col("page")).alias("day_of_page"), days_in_month(month).alias("days_in_month"), "events"
        )
    )


def entry_table(spark, folder) -> DataFrame:
    return entries(page_items(given(spark, folder, "pages")))


def page_entries(spark, folder):
    return report(
        entry_table(spark, folder).select(
            "page_id", "list_no", "item_no", "event_type", "text", F.size("links").alias("n_links")
        )
    )


def entry_counts(spark, folder):
    return report(entry_table(spark, folder).groupBy("page_id", "event_type").agg(F.count("*").alias("entries")))


def entry_links(spark, folder):
    links = entry_table(spark, folder).select("page_id", "list_no", "item_no", F.posexplode(filled_links(F.col("links"))))
    return report(links.select("page_id", "list_no", "item_no", F.col("pos").alias("link_no"), "col.tag", "col.link"))


def link_slots(spark, folder):
    """Flat export with 20 tags and 20 links; the page's own date is blanked."""
    dated = entry_table(spark, folder).withColumn("date", url_tag(F.col("url")))
    kept = dated.withColumn("links", blank_own_date(F.slice("links", 1, MAX_LINKS), F.col("date")))
    return report(kept.select("page_id", "list_no", "item_no", "date", "event_type", "text", *slots(F.col("links"))))


def signed_years(spark, folder):
    """Every line of every document read as an entry; lines without a digit drop out."""
    texts = given(spark, folder, "documents").select("doc_id", "text")
    lines = texts.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    text = strip_citations(F.col("line"))
    dated = lines.select("doc_id", "line_no", text.alias("text")).filter(F.col("text").rlike("[0-9]"))
    return report(
        dated.select("doc_id", "line_no", signed_year(F.col("text")).alias("year"), entry_body(F.col("text")).alias("body"))
    )


QUERIES = {
    f.__name__: f
    for f in (
        valid_month_days, month_day_year_search, page_entries, entry_counts, entry_links, link_slots, signed_years,
        calendar_pages,
    )
}

# The generated pages hold one flat list of plain links each, which a pattern can read.
ITEMS_SQL = """
found AS (
  SELECT page_id, url,
         regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
         regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS texts
  FROM pages),
numbered AS (SELECT page_id, url, hrefs, texts, UNNEST(range(len(hrefs))) AS item_no FROM found),
items AS (
  SELECT page_id, url, item_no, texts[item_no + 1] AS text,
         regexp_extract(url, '^https?://[^/]+') || hrefs[item_no + 1] AS link,
         trim(url_decode(replace(regexp_extract(hrefs[item_no + 1], '[^/]*$'), '_', ' '))) AS tag,
         NOT regexp_full_match(texts[item_no + 1], '[0-9]+') AS linked
  FROM numbered)"""
TAG_OF_URL_SQL = r"regexp_extract(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '[^/]*$')"
_EMPTY = ", ".join(
    [f"CAST(NULL AS VARCHAR) AS tag_{i}" for i in range(2, 21)] + [f"CAST(NULL AS VARCHAR) AS link_{i}" for i in range(2, 21)]
)
_OWN = "linked AND (tag <> date OR contains(tag, 'BC'))"

ORACLES = {
    "valid_month_days": f"""WITH days AS (
  SELECT UNNEST(generate_series(TIMESTAMP '1900-01-01', TIMESTAMP '1900-12-31', INTERVAL 1 DAY)) AS d),
counted AS (SELECT strftime(ts, '%B %-d') AS month_day, COUNT(*) AS n FROM events GROUP BY 1)
SELECT DAYOFYEAR(d) AS day_of_year, strftime(d, '%B %-d') AS month_day, COALESCE(n, 0) AS events
FROM days LEFT JOIN counted ON month_day = strftime(d, '%B %-d')
UNION ALL
SELECT NULL, '{NO_DAY}', CAST(COALESCE(SUM(n), 0) AS BIGINT) FROM counted
WHERE month_day IS NULL OR month_day NOT IN (SELECT strftime(d, '%B %-d') FROM days)""",
    "month_day_year_search": f"""SELECT event_id AS id, strftime(ts, '%B %-d') AS date, YEAR(ts) AS year, event_type, props AS text
FROM events WHERE event_type = '{EVENT_TYPE}' AND YEAR(ts) BETWEEN {FIRST_YEAR} AND {LAST_YEAR}
AND strftime(ts, '%m%d') BETWEEN strftime(strptime('2000 {FIRST_DAY}', '%Y %B %d'), '%m%d')
                             AND strftime(strptime('2000 {LAST_DAY}', '%Y %B %d'), '%m%d')""",
    "calendar_pages": """
WITH named AS (SELECT strftime(ts, '%B %-d') AS month_day, DAY(LAST_DAY(MAKE_DATE(2001, MONTH(ts), 1))) AS days FROM events)
SELECT month_day, replace(month_day, ' ', '_') AS page, month_day AS day_of_page, days AS days_in_month, COUNT(*) AS events
FROM named GROUP BY month_day, days""",
    "page_entries": f"""WITH {ITEMS_SQL}
SELECT page_id, CAST(0 AS BIGINT) AS list_no, item_no, 'event' AS event_type, text, CAST(linked AS BIGINT) AS n_links FROM items""",
    "entry_counts": f"""WITH {ITEMS_SQL}
SELECT page_id, 'event' AS event_type, COUNT(*) AS entries FROM items GROUP BY page_id""",
    "entry_links": f"""WITH {ITEMS_SQL}
SELECT page_id, CAST(0 AS BIGINT) AS list_no, item_no, CAST(0 AS BIGINT) AS link_no, tag, link FROM items WHERE linked""",
    "link_slots": f"""WITH {ITEMS_SQL}, dated AS (SELECT *, {TAG_OF_URL_SQL} AS date FROM items)
SELECT page_id, CAST(0 AS BIGINT) AS list_no, item_no, date, 'event' AS event_type, text,
       CASE WHEN {_OWN} THEN tag END AS tag_1, CASE WHEN {_OWN} THEN link END AS link_1, {_EMPTY}
FROM dated""",
    "signed_years": r"""WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
numbered AS (SELECT doc_id, parts, UNNEST(range(len(parts))) AS line_no FROM split),
clean AS (
  SELECT doc_id, line_no,
         regexp_replace(regexp_replace(parts[line_no + 1], '\[[0-9]+\]', '', 'g'), '^[ \t\n\f\r\v]+|[ \t\n\f\r\v]+$', '', 'g') AS text
  FROM numbered),
words AS (SELECT *, string_split(text, ' ') AS w, array_to_string(string_split(text, ' ')[3:], ' ') AS rest FROM clean
          WHERE regexp_matches(text, '[0-9]')),
first AS (SELECT *, CASE WHEN w[1] = 'AD' THEN w[2] ELSE w[1] END AS word FROM words),
dated AS (SELECT *, TRY_CAST(CASE WHEN regexp_full_match(word, '[0-9]+') THEN word
                                  ELSE regexp_extract(text, '[0-9]+') END AS BIGINT) AS year FROM first)
SELECT doc_id, line_no,
       CASE WHEN regexp_matches(string_split(text, '–')[1], '\bBC\b') THEN -year ELSE year END AS year,
       CASE WHEN rest LIKE '–%' THEN regexp_replace(rest[2:], '^[ \t\n\f\r\v]+|[ \t\n\f\r\v]+$', '', 'g') ELSE rest END AS body
FROM dated""",
}
