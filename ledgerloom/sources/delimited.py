"""Delimited text: retail lines, survey files with two header lines, passenger lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import county_name
from ..operators.reshape import stack

RETAIL_SCHEMA = (
    "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp, "
    "UnitPrice decimal(18,2), CustomerID string, Country string"
)
PASSENGER_SCHEMA = (
    "survived int, sex string, age double, n_siblings_spouses int, parch int, fare double, "
    "class string, deck string, embark_town string, alone string"
)
LABEL_ROW = "Geographic Area Name"
# Widest survey file that is read without asking for more; a wider one is an error, not cut.
SURVEY_WIDTH = 1024
# The year in a file name such as ``ACSST1Y2015.S1901-Data.csv``.
YEAR_IN_NAME = r"Y(\d{4})\b[^/]*$"


def read_csv(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """CSV with a header line and a stated schema, so that no pass is spent on guessing.

    The header is checked against the schema: a file with other columns is an error.
    """
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).options(**options).csv(path)


def read_retail(spark: SparkSession, path: str, schema: str = RETAIL_SCHEMA, **options: str) -> DataFrame:
    return read_csv(spark, path, schema, **options)


def read_passengers(spark: SparkSession, path: str) -> DataFrame:
    """The label ``survived`` stays in the row."""
    return read_csv(spark, path, PASSENGER_SCHEMA)


def read_survey_year(spark: SparkSession, path: str, year: int) -> DataFrame:
    """One year's survey file as (area, county, year, code, label, raw, value).

    The first line holds column codes, the second their labels.  Cells that are no numbers
    (``N``, ``(X)``, ``**``, ``-``) have a null value and keep their text in ``raw``.
    """
    header = spark.read.option("header", True).csv(path).columns
    names = [c.lstrip("﻿").strip('"') for c in header]
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    # Lines end in a comma; the empty field behind it has no name.
    codes = {f"c{i}": n for i, n in enumerate(names) if n not in ("", "GEO_ID", "NAME") and not n.startswith("_c")}
    area = f"c{names.index('NAME')}"
    rows = spark.read.schema(schema).option("header", True).csv(path)
    long = (
        rows.select(F.col(area).alias("area"), *[F.col(c).alias(n) for c, n in codes.items()])
        .unpivot(["area"], list(codes.values()), "code", "raw")
    )
    # One label per column of the file: small by construction.
    labels = long.filter(F.col("area") == LABEL_ROW).select("code", F.col("raw").alias("label"))
    return (
        long.filter(F.col("area") != LABEL_ROW)
        .join(F.broadcast(labels), "code")
        .select(
            "area",
            county_name(F.col("area")).alias("county"),
            F.lit(year).alias("year"),
            "code",
            "label",
            "raw",
            F.col("raw").try_cast("decimal(18,4)").alias("value"),
        )
    )


def read_survey(spark: SparkSession, paths: Mapping[int, str]) -> DataFrame:
    """Several years, each with its own header."""
    return stack([read_survey_year(spark, path, year) for year, path in paths.items()])


def read_survey_metadata(spark: SparkSession, paths: str | Sequence[str], year_pattern: str = YEAR_IN_NAME) -> DataFrame:
    """Column dictionaries, one file per survey file, as (year, code, label); all files are one scan."""
    rows = spark.read.schema("code string, label string").option("header", True).csv(paths)
    year = F.regexp_extract(F.col("_metadata.file_path"), year_pattern, 1).try_cast("int")
    return rows.select(year.alias("year"), "code", "label").filter("label IS NOT NULL")


def read_survey_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    metadata: DataFrame | None = None,
    width: int = SURVEY_WIDTH,
    year_pattern: str = YEAR_IN_NAME,
) -> DataFrame:
    """Survey files of any number of years and headings (paths or globs) as in :func:`read_survey_year`.

    All files are one scan and no file is opened by the driver.  A cell finds the code and the label of
    its column among the cells of the same file and place, so a task holds one column of one file.
    The year stands in the file's name.  Labels come from ``metadata`` (year, code, label) where it has
    them, else from the file's second line.  Empty cells have no row.  The area name is the second
    column, as in all files of the survey; a file with another one there is an error, as is a wider one than ``width``.
    """
    cells = [f"c{i}" for i in range(width + 1)]
    lines = spark.read.schema(StructType([StructField(c, StringType()) for c in cells])).csv(paths)
    wide = F.when(F.col(cells[-1]).isNotNull(), F.raise_error(F.lit(f"a survey file has more than {width} columns")).cast("string"))
    first = F.ltrim(F.col("c0"), F.lit("\ufeff"))
    is_code = F.trim(first, F.lit('"')) == "GEO_ID"
    other = F.when(is_code & ~F.col("c1").eqNullSafe(F.lit("NAME")), F.raise_error(F.lit("the second column is not NAME")).cast("string"))
    long = lines.select(
        F.coalesce(wide, other, F.col("_metadata.file_path")).alias("file"),
        F.coalesce(is_code, F.lit(False)).alias("is_code"),
        F.col("c1").alias("area"),
        F.posexplode(F.array(*cells[2:-1])).alias("place", "raw"),
    ).filter("raw IS NOT NULL")
    column = Window.partitionBy("file", "place")
    is_label = ~F.col("is_code") & (F.col("area") == LABEL_ROW)
    headed = (
        long.withColumn("code", F.max(F.when(F.col("is_code"), F.col("raw"))).over(column))
        .withColumn("label", F.max(F.when(is_label, F.col("raw"))).over(column))
        .filter(~F.col("is_code") & ~F.col("area").eqNullSafe(F.lit(LABEL_ROW)) & F.col("code").isNotNull())
        .withColumn("year", F.regexp_extract("file", year_pattern, 1).try_cast("int"))
    )
    if metadata is not None:
        known = metadata.select("year", "code", F.col("label").alias("_known"))
        headed = headed.join(known, ["year", "code"], "left").withColumn("label", F.coalesce("_known", "label"))
    return headed.select(
        "area",
        county_name(F.col("area")).alias("county"),
        "year",
        "code",
        "label",
        "raw",
        F.col("raw").try_cast("decimal(18,4)").alias("value"),
    )


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """CSV with a header line in each file, written in parallel."""
    df.write.mode(mode).partitionBy(*partition_by).option("header", True).csv(path)
