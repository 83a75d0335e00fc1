import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from jobmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="jobmart-tests-")
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"{scratch}/shared",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture
def column(spark):
    """Apply a column function to strings and collect the results."""
    from pyspark.sql import functions as F

    def apply(function, values):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, v string").select("i", function(F.col("v")).alias("r"))
        return [r["r"] for r in df.orderBy("i").collect()]

    return apply
