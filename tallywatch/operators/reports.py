"""Reporting queries over scored counts: location_name, crime_type, timestamp, incident_count, anomaly_score."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.scores import DEFAULT_THRESHOLD, above, two_decimals
from tallywatch.functions.times import DISPLAY_MINUTES, in_report_range

HISTOGRAM_BINS = 20
RECENT = 5


def series_of(hourly_scores: DataFrame) -> DataFrame:
    """A scored hourly table in the shape that reports take; an hour is named by its start.

    The anomaly score of a report is continuous, from 0 to 1: the raw score of the forest with its sign turned, so that
    thresholds and histograms tell more than the label does.
    """
    return hourly_scores.select(
        "location_name", "crime_type", F.col("window_start").alias("timestamp"),
        "incident_count", (-F.col("raw_score")).alias("anomaly_score"), "is_anomaly",
    )


def for_place_and_type(scored: DataFrame, place: str, crime_type: str) -> DataFrame:
    return scored.filter((F.col("location_name") == place) & (F.col("crime_type") == crime_type))


def in_range(scored: DataFrame, as_of: datetime, time_range: str) -> DataFrame:
    return scored.filter(in_report_range(F.col("timestamp"), as_of, time_range))


def flagged(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Set is_anomaly from the threshold, over any flag that came with the row. No score, no anomaly."""
    return scored.withColumn("is_anomaly", F.coalesce(above(F.col("anomaly_score"), threshold), F.lit(False)))


def anomalies(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """The rows that flagged would mark. The test is on the score itself, so that a scan can use it."""
    return flagged(scored.filter(above(F.col("anomaly_score"), threshold)), threshold)


def series(scored: DataFrame) -> DataFrame:
    return scored.select("timestamp", "incident_count").orderBy("timestamp", "incident_count")


def type_distribution(scored: DataFrame, place: str) -> DataFrame:
    """Totals per type in one place, over all times and types."""
    return (
        scored.filter((F.col("location_name") == place) & F.col("crime_type").isNotNull())
        .groupBy("crime_type")
        .agg(F.sum("incident_count").alias("incident_count"))
    )


def score_histogram(scored: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Rows per equal-width bin of scores from 0 to 1; a score of 1 belongs to the last bin."""
    bin_number = F.floor(F.least(F.col("anomaly_score") * bins, F.lit(float(bins - 1))))
    return (
        scored.filter(F.col("anomaly_score").isNotNull())
        .groupBy(bin_number.alias("bin"))
        .agg(F.count("*").alias("n"))
        .select("bin", (F.col("bin") / F.lit(float(bins))).alias("bin_start"), "n")
    )


def anomaly_metrics(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Total incidents, incidents in flagged rows and their share in percent, in one pass."""
    amount = F.col("incident_count")
    flagged_amount = F.when(above(F.col("anomaly_score"), threshold), amount)
    total, anomalous = F.col("total_incidents"), F.col("anomalous_incidents")
    return scored.agg(
        F.coalesce(F.sum(amount), F.lit(0)).alias("total_incidents"),
        F.coalesce(F.sum(flagged_amount), F.lit(0)).alias("anomalous_incidents"),
    ).select(
        total,
        anomalous,
        F.when(total > 0, two_decimals(anomalous / F.nullif(total, F.lit(0)) * 100))
        .otherwise(F.lit(0.0))
        .alias("anomaly_percentage"),
        F.lit(float(threshold)).alias("threshold"),
    )


def recent_anomalies(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD, n: int = RECENT) -> DataFrame:
    """The latest flagged rows; rows of one instant are ordered by their other values."""
    return (
        anomalies(scored, threshold)
        .orderBy(F.col("timestamp").desc(), F.col("incident_count").desc(), F.col("anomaly_score").desc())
        .limit(n)
        .select(
            F.date_format("timestamp", DISPLAY_MINUTES).alias("timestamp"),
            "incident_count",
            two_decimals(F.col("anomaly_score")).alias("anomaly_score"),
        )
    )


def options(scored: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, in order."""
    return scored.select(column).distinct().orderBy(column)
