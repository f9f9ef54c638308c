import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from assayline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "4",
        "assayline-tests",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over one row with text column ``t``."""

    def value(make, text, kind="string"):
        df = spark.createDataFrame([(text,)], f"t {kind}")
        from pyspark.sql import functions as F

        return df.select(make(F.col("t"))).first()[0]

    return value


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def final_plan(df) -> str:
    """Executed plan after adaptive re-planning."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
