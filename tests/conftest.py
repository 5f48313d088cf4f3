import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[*]")
        .appName("stellate-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="stellate-wh-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Tests run without a cluster-named checkpoint folder; give them a fresh one.
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stellate-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="stellate-test-")


def rows(df, order=None):
    """Collected rows as sorted tuples (order-insensitive compare)."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
