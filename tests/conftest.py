import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("calepin-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a column rule to literal texts and return the results in order."""
    from pyspark.sql import functions as F

    def run(rule, *inputs):
        rows = [(i, *(value if isinstance(value, tuple) else (value,))) for i, value in enumerate(inputs)]
        names = [f"c{k}" for k in range(len(rows[0]) - 1)]
        schema = "i int, " + ", ".join(f"{name} string" for name in names)
        df = spark.createDataFrame(rows, schema)
        result = df.select("i", rule(*(F.col(name) for name in names)).alias("r")).orderBy("i")
        return [row.r for row in result.collect()]

    return run
