"""Photo captures: nested documents, insert if absent, counts per camera and week.

Events stand for photos: type as camera, day as earth date, days since the first event as sol.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import ANCHOR_DATE, ANCHOR_SOL, EARTH_DAYS_PER_SOL, mission_sol, week_start
from ..operators.filters import filter_if_any, in_date_range, trailing_window as last_units
from ..sources.nested import flatten_photos, parse_photo_page
from ..sources.tables import absent_rows
from .common import given, report

# Parameters of the registered queries.
TRAILING_SOLS = 15
KEPT_SOLS = 10
FIRST_DAY, LAST_DAY = "2024-01-05", "2024-01-20"
CAMERA = "view"
CAMERAS = ["view", "click"]
LAUNCHED, LANDED = "2011-11-26", "2012-08-06"


def captures(spark, folder) -> DataFrame:
    events = given(spark, folder, "events")
    start = events.agg(F.to_date(F.min("ts"))).scalar()
    day = F.to_date("ts")
    return events.select(
        F.col("event_id").alias("id"),
        F.datediff(day, start).alias("sol"),
        F.col("event_type").alias("camera"),
        F.concat(F.lit("https://photos.example/"), F.col("user_id"), F.lit(".jpg")).alias("img_src"),
        day.alias("earth_date"),
        F.concat(F.lit("rover_"), F.col("user_id") % 4).alias("rover"),
        F.lit("active").alias("status"),
        F.get_json_object("props", "$.k").cast("bigint").alias("max_sol"),
        F.col("user_id").alias("total_photos"),
        F.lit(LAUNCHED).cast("date").alias("launch_date"),
        F.lit(LANDED).cast("date").alias("landing_date"),
    )


def _pages(spark, folder) -> DataFrame:
    """The captures as nested JSON documents."""
    photo = F.struct(
        "id", "sol", F.struct(F.col("camera").alias("name")).alias("camera"), "img_src",
        F.col("earth_date").cast("string").alias("earth_date"),
        F.struct(
            F.col("rover").alias("name"), "status", "max_sol", "total_photos",
            F.col("launch_date").cast("string").alias("launch_date"),
            F.col("landing_date").cast("string").alias("landing_date"),
        ).alias("rover"),
    )
    return captures(spark, folder).select(F.to_json(F.struct(F.array(photo).alias("photos"))).alias("document"))


def flatten_nested(spark, folder):
    pages = _pages(spark, folder).select(parse_photo_page(F.col("document")).alias("page")).select("page.photos")
    return report(flatten_photos(pages))


def insert_if_absent(spark, folder):
    """A landed table meets a backfill of the last sols that overlaps it and holds every photo twice."""
    photos = captures(spark, folder).select("id", "sol", "camera", "img_src", "earth_date", "status")
    latest = photos.agg(F.max("sol")).scalar()
    landed = photos.filter(F.col("sol") <= latest - KEPT_SOLS)
    window = last_units(photos, "sol", TRAILING_SOLS)
    batch = window.unionByName(window.withColumn("status", F.lit("late")))
    fresh = absent_rows(batch, landed, ["id"], ["status"])
    return report(
        landed.withColumn("origin", F.lit("landed")).unionByName(fresh.withColumn("origin", F.lit("inserted")))
    )


def trailing_window(spark, folder):
    return report(last_units(captures(spark, folder).select("id", "sol", "camera"), "sol", KEPT_SOLS))


def smallest_reported(spark, folder):
    """Smallest of the distinct values of a reported number."""
    return report(captures(spark, folder).agg(F.min("max_sol").alias("max_sol")))


def count_per_rover(spark, folder):
    """The key itself is not shown."""
    return report(captures(spark, folder).groupBy("rover").agg(F.count("rover").alias("total")).drop("rover"))


def count_per_camera(spark, folder):
    return report(captures(spark, folder).groupBy("camera").agg(F.count("img_src").alias("photos")))


def count_per_camera_week(spark, folder):
    weekly = captures(spark, folder).groupBy(week_start(F.col("earth_date")).alias("week"), "camera")
    return report(weekly.agg(F.count("img_src").alias("photos")))


def last_capture(spark, folder):
    return report(
        captures(spark, folder).agg(F.max("earth_date").alias("last_photo_date"), F.max("sol").alias("last_photo_sol"))
    )


def week_axis(spark, folder):
    day = F.col("earth_date")
    weeks = captures(spark, folder).select(
        week_start(day).alias("sunday_week"), week_start(day, "monday").alias("monday_week")
    )
    return report(weeks.distinct())


def date_range_detail(spark, folder):
    """Per photo and camera the date, or ``*`` where there are several."""
    chosen = captures(spark, folder).filter(
        in_date_range(F.col("earth_date"), F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date"))
    )
    lowest, highest = F.min("earth_date"), F.max("earth_date")
    one_date = F.when(lowest == highest, lowest.cast("string")).otherwise("*")
    return report(chosen.groupBy("img_src", "camera").agg(one_date.alias("earth_date")))


def member_filter(spark, folder):
    chosen = captures(spark, folder).filter(F.col("camera") == CAMERA)
    return report(chosen.groupBy("camera", "earth_date").agg(F.count("img_src").alias("photos")))


def optional_filters(spark, folder):
    """Cameras are selected, weeks are not; plus an alias column and a constant one."""
    photos = captures(spark, folder).withColumn("week", week_start(F.col("earth_date")))
    chosen = filter_if_any(filter_if_any(photos, "camera", CAMERAS), "week", [])
    return report(chosen.select("id", "camera", "week", F.col("img_src").alias("image_url"), F.lit("ALL").alias("label")))


def mission_day(spark, folder):
    days = captures(spark, folder).groupBy("earth_date").agg(F.count("*").alias("photos"))
    return report(days.withColumn("mission_sol", mission_sol(F.col("earth_date"))))


QUERIES = {
    f.__name__: f
    for f in (
        flatten_nested, insert_if_absent, trailing_window, smallest_reported, count_per_rover,
        count_per_camera, count_per_camera_week, last_capture, week_axis, date_range_detail,
        member_filter, optional_filters, mission_day,
    )
}

CAPTURES_SQL = f"""
first AS (SELECT MIN(CAST(ts AS DATE)) AS start FROM events),
captures AS (
  SELECT event_id AS id, DATE_DIFF('day', start, CAST(ts AS DATE)) AS sol, event_type AS camera,
         'https://photos.example/' || user_id || '.jpg' AS img_src, CAST(ts AS DATE) AS earth_date,
         'rover_' || (user_id % 4) AS rover, 'active' AS status,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS max_sol, user_id AS total_photos,
         '{LAUNCHED}' AS launch_date, '{LANDED}' AS landing_date
  FROM events, first)"""
SUNDAY_SQL = "CAST(earth_date - CAST(DAYOFWEEK(earth_date) AS INTEGER) AS VARCHAR)"

ORACLES = {
    "flatten_nested": f"""WITH {CAPTURES_SQL}
SELECT id, sol, camera, img_src, CAST(earth_date AS VARCHAR) AS earth_date, rover, status, max_sol, total_photos,
       launch_date, landing_date FROM captures""",
    "insert_if_absent": f"""WITH {CAPTURES_SQL}, latest AS (SELECT MAX(sol) AS last FROM captures)
SELECT id, sol, camera, img_src, CAST(earth_date AS VARCHAR) AS earth_date, status,
       CASE WHEN sol <= last - {KEPT_SOLS} THEN 'landed' ELSE 'inserted' END AS origin
FROM captures, latest WHERE sol <= last - {KEPT_SOLS} OR sol > last - {TRAILING_SOLS}""",
    "trailing_window": f"""WITH {CAPTURES_SQL} SELECT id, sol, camera FROM captures
WHERE sol > (SELECT MAX(sol) FROM captures) - {KEPT_SOLS}""",
    "smallest_reported": f"WITH {CAPTURES_SQL} SELECT MIN(max_sol) AS max_sol FROM captures",
    "count_per_rover": f"WITH {CAPTURES_SQL} SELECT COUNT(rover) AS total FROM captures GROUP BY rover",
    "count_per_camera": f"WITH {CAPTURES_SQL} SELECT camera, COUNT(img_src) AS photos FROM captures GROUP BY camera",
    "count_per_camera_week": f"""WITH {CAPTURES_SQL}
SELECT {SUNDAY_SQL} AS week, camera, COUNT(img_src) AS photos FROM captures GROUP BY ALL""",
    "last_capture": f"""WITH {CAPTURES_SQL}
SELECT CAST(MAX(earth_date) AS VARCHAR) AS last_photo_date, MAX(sol) AS last_photo_sol FROM captures""",
    "week_axis": f"""WITH {CAPTURES_SQL}
SELECT DISTINCT {SUNDAY_SQL} AS sunday_week, CAST(CAST(DATE_TRUNC('week', earth_date) AS DATE) AS VARCHAR) AS monday_week
FROM captures""",
    "date_range_detail": f"""WITH {CAPTURES_SQL}
SELECT img_src, camera,
       CASE WHEN MIN(captures.earth_date) = MAX(captures.earth_date) THEN CAST(MIN(captures.earth_date) AS VARCHAR) ELSE '*' END AS earth_date
FROM captures WHERE captures.earth_date BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}' GROUP BY img_src, camera""",
    "member_filter": f"""WITH {CAPTURES_SQL}
SELECT camera, CAST(captures.earth_date AS VARCHAR) AS earth_date, COUNT(img_src) AS photos FROM captures
WHERE camera = '{CAMERA}' GROUP BY camera, captures.earth_date""",
    "optional_filters": f"""WITH {CAPTURES_SQL}
SELECT id, camera, {SUNDAY_SQL} AS week, img_src AS image_url, 'ALL' AS label FROM captures
WHERE camera IN ({', '.join(f"'{c}'" for c in CAMERAS)})""",
    "mission_day": f"""WITH {CAPTURES_SQL}
SELECT CAST(captures.earth_date AS VARCHAR) AS earth_date, COUNT(*) AS photos,
  CAST(ROUND({ANCHOR_SOL} + DATE_DIFF('day', DATE '{ANCHOR_DATE}', captures.earth_date) / CAST({EARTH_DAYS_PER_SOL} AS DOUBLE)) AS BIGINT) AS mission_sol
FROM captures GROUP BY captures.earth_date""",
}
