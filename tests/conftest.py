import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("plumbline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def loans(spark):
    """The hand-computed loan table."""
    from plumbline.plans.loans import LOAN_SCHEMA

    rows = [
        (0, 1, 25.0, 5e5, 700.0, 1e5, 0, "North", "Employed", "Male", "Single", "2023-01-01", 0),
        (1, 2, None, 6e5, 1200.0, 2e5, 1, "South  ", "Self-Employed", "male", "Married", "02/01/2023", 0),
        (2, 3, -5.0, None, 650.0, -10.0, 2, "East", "self-employed ", "F", "Widowed", "03-Jan-2023", 1),
        (3, 1, 25.0, 5e5, 700.0, 1e5, 0, "North", "Employed", "Male", "Single", "2023-01-01", 0),
        (4, 4, 40.0, -1e5, None, 3e5, 0, "West", None, "Female", "Divorced", "01/05/2023", 0),
        (5, 5, 101.0, 1e8, 300.0, 1e8, 0, "north", "Student", "M", "single", "2023-01-06", 0),
        (6, None, 18.0, 0.0, 900.0, 0.0, 4, "Central", "Retired", "Female", "Married", "2023-01-07", 0),
        (7, None, 100.0, 7e5, 299.0, 5.0, 3, "Central", "Unemployed", "Female", "Partnered", "2023-01-08", 1),
    ]
    schema = "row_id long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LOAN_SCHEMA)
    return spark.createDataFrame(rows, schema)
