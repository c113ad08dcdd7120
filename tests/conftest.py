import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("adlake tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from adlake.plans.lake import lake as open_lake

    return open_lake(spark, TESTDATA)


@pytest.fixture(scope="session")
def literal_feeds(spark):
    from feeds import literal_feeds as build

    return build(spark)


@pytest.fixture(scope="session")
def loaded(spark, literal_feeds, tmp_path_factory):
    """The load job run over the literal feeds."""
    from adlake.plans.medallion import Medallion
    from adlake.sources.tables import TableStore

    job = Medallion(TableStore(spark, str(tmp_path_factory.mktemp("lake"))))
    job.run(literal_feeds)
    return job


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().toString()
