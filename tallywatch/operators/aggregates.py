"""Counts and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = "1 hour"
LATENESS = "1 hour"


def hourly_counts(unified: DataFrame, window: str = WINDOW, lateness: str = LATENESS) -> DataFrame:
    """Incidents per window, source, place and type; the same plan serves batches and streams.

    Rows without an event time are left out. Partial counts are made before the shuffle, so a place
    that holds much of the input sends one row per task and window.
    """
    return (
        unified.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", window).alias("window"), "source", "location_name", "crime_type")
        .agg(F.count("*").alias("incident_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "source", "location_name", "crime_type", "incident_count",
        )
    )


def ingest_counts(records: DataFrame, city: str = "location_name") -> DataFrame:
    """Records per city of the UK source, per source, and in total."""
    uk_city = F.when(F.col("source") == "uk_police", F.col(city))
    small = records.groupBy("source", uk_city.alias("city")).agg(F.count("*").alias("n"))
    scopes = F.array(
        F.struct(F.lit("total").alias("scope"), F.lit("all").alias("name")),
        F.struct(F.lit("source").alias("scope"), F.col("source").alias("name")),
        F.struct(F.lit("city").alias("scope"), F.col("city").alias("name")),
    )
    return (
        small.select(F.inline(scopes), "n")
        .filter((F.col("scope") != "city") | F.col("name").isNotNull())
        .groupBy("scope", "name")
        .agg(F.sum("n").alias("records"))
    )
