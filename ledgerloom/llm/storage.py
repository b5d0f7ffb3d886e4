"""Tables in, work tables out."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Folders made for sessions that name none, by application.
_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a temporary one for a local session without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="ledgerloom-llm-")
    return _OWN[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a work table to the shared folder and go on from there, so that lost executors cost no earlier stage."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def all_of(df: DataFrame) -> list[Column]:
    """The table's own columns, whatever their names."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z, all else as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_bucket(column: Column, parts: int) -> Column:
    """crc32 of an id written as text, modulo ``parts``; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(parts))
