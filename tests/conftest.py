from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from iterweave.tuning import Tuning  # noqa: E402
from iterweave.workspace import Workspace, close_all  # noqa: E402

# Pieces so small that tiny inputs are cut as large ones are: hot keys sliced, edges in
# several buckets, pairs in blocks.
LARGE = Tuning(hot_key_rows=3, pair_block_rows=2, settled_block=4, bucket_rows=10)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("iterweave-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def nothing_left_behind():
    yield
    close_all()


@pytest.fixture
def ws(spark):
    with Workspace(spark) as workspace:
        yield workspace


@pytest.fixture
def large_ws(spark):
    with Workspace(spark, tuning=LARGE) as workspace:
        yield workspace


@pytest.fixture(params=["default", "large"])
def any_ws(spark, request):
    tuning = {"default": Tuning(), "large": LARGE}[request.param]
    with Workspace(spark, tuning=tuning) as workspace:
        yield workspace


@pytest.fixture
def table(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


def rows(df, *columns):
    """Sorted list of plain tuples."""
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
