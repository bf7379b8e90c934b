import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from ledgerstone.session import local_session

    session = local_session("tests", cpus="8", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def values(spark):
    """Evaluate a column function over single values."""
    from pyspark.sql import functions as F

    def run(function, inputs, kind="string"):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
        return [r[0] for r in frame.orderBy("i").select(function(F.col("v")).alias("r")).collect()]

    return run
