from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyspark.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("work")
    session = build_session(
        "tests", "local[8]", 8, {"spark.checkpoint.dir": str(folder), "spark.sql.shuffle.partitions": "8"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Make a DataFrame from tuples and a schema, spread over some partitions."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


def rows(df, *order):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
