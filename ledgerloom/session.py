"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "ledgerloom") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the session is given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        # Small files are cut for all cores, as costly work per row may follow the scan.
        .config("spark.sql.files.minPartitionNum", cores)
        .config("spark.sql.files.openCostInBytes", "65536")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
