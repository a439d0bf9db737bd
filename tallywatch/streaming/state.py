"""What the hourly query holds in its state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.schema import HOURLY


def open_hours(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Counts so far of the hours that are not closed yet, as the last batch, or the one named, left them.

    They are read from the checkpoint of `start_hourly`, one task per state partition; the query may be running. Together
    with the table the query writes they are all hours counted. A query that has not finished a batch has no state to read.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint)
    count = state.schema["value"].dataType.fieldNames()[0]
    return state.select(
        F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"),
        "key.source", "key.location_name", "key.crime_type", F.col("value")[count].alias("incident_count"),
    ).to(HOURLY)
