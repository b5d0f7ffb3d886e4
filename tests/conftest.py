import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="ledgerloom-")
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """Text of the physical plan before adaptive changes."""

    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text
