"""Nested photo documents as landed from a paged API."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PHOTO_PAGE_SCHEMA = (
    "photos array<struct<id: bigint, sol: int, camera: struct<name: string>, img_src: string, earth_date: string, "
    "rover: struct<name: string, status: string, max_sol: bigint, total_photos: bigint, launch_date: string, "
    "landing_date: string>>>"
)


def read_photo_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON pages (one document per line) with the schema stated."""
    return spark.read.schema(PHOTO_PAGE_SCHEMA).json(path)


def parse_photo_page(text: Column) -> Column:
    return F.from_json(text, PHOTO_PAGE_SCHEMA)


def flatten_photos(pages: DataFrame) -> DataFrame:
    """One row per photo, nested fields as flat columns, dates as dates."""
    # The outer form: for the plain one Spark adds a filter on the array's size, which would
    # parse a document once more for it where the pages come from text.
    photo = pages.select(F.posexplode_outer("photos").alias("place", "p")).filter("place is not null")
    return photo.select(
        "p.id",
        "p.sol",
        F.col("p.camera.name").alias("camera"),
        "p.img_src",
        F.col("p.earth_date").try_cast("date").alias("earth_date"),
        F.col("p.rover.name").alias("rover"),
        "p.rover.status",
        "p.rover.max_sol",
        "p.rover.total_photos",
        F.col("p.rover.launch_date").try_cast("date").alias("launch_date"),
        F.col("p.rover.landing_date").try_cast("date").alias("landing_date"),
    )
