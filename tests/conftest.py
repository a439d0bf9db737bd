import os

import pytest
from pyspark.sql import functions as F

from tallywatch.session import CHECKPOINT_DIR, build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.default.parallelism": "4",
            CHECKPOINT_DIR: str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(frame, *columns):
        picked = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


@pytest.fixture(scope="session")
def planted(spark):
    """1,000 ordinary hourly rows and ten with counts far above them."""
    n = 1010
    frame = spark.range(n, numPartitions=4)
    place = F.concat(F.lit("P"), F.col("id") % 4)
    kind = F.concat(F.lit("T"), (F.col("id") / 4).cast("long") % 5)
    return frame.select(
        F.timestamp_seconds(F.col("id") * 3600).alias("window_start"),
        F.timestamp_seconds((F.col("id") + 1) * 3600).alias("window_end"),
        F.lit("uk_police").alias("source"),
        place.alias("location_name"),
        kind.alias("crime_type"),
        F.when(F.col("id") < 1000, 5 + F.pmod(F.xxhash64("id"), F.lit(11)))
        .otherwise(200 + F.col("id") - 1000).alias("incident_count"),
    )
