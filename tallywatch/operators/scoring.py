"""Scores for counts and for requests, in batches and in streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.scores import (
    COUNT_FEATURE, is_outlier, label, merged_features, place_feature, rescaled, type_feature,
)
from tallywatch.operators.forest import SCORE_DECIMALS, Forest

REQUIRED = ("location_name", "crime_type", "incident_count")


@dataclass(frozen=True)
class Model:
    """A forest and the score below which a row is an outlier."""

    forest: Forest
    offset: float
    contamination: float
    seed: int


def with_scores(frame: DataFrame, model: Model, raw_score: Column) -> DataFrame:
    return (
        frame.withColumn("raw_score", raw_score)
        .withColumn("decision", F.round(F.col("raw_score") - F.lit(model.offset), SCORE_DECIMALS))
        .withColumn("label", label(F.col("decision")))
        .withColumn("anomaly_score", rescaled(F.col("label")))
        .withColumn("is_anomaly", is_outlier(F.col("label")))
    )


def score_counts(counts: DataFrame, model: Model) -> DataFrame:
    """Add scores to a table or stream of counts. Rows stay where they are: no shuffle, no join."""
    columns = [F.col(name) for name in (COUNT_FEATURE, "location_name", "crime_type")]
    return with_scores(counts, model, model.forest.raw_score(*columns))


def invalid_field() -> Column:
    """First field that keeps a request from being answered: a required one that is missing, or additional
    features among which one has no value. NULL for a request that is in order."""
    missing = [F.when(F.col(name).isNull(), F.lit(name)) for name in REQUIRED]
    features = F.col("additional_features")
    without_value = F.exists(F.map_values(features), lambda value: value.isNull())
    return F.coalesce(*missing, F.when(without_value, F.lit("additional_features")))


def valid_requests(requests: DataFrame) -> DataFrame:
    return requests.filter(invalid_field().isNull())


def invalid_requests(requests: DataFrame) -> DataFrame:
    return requests.withColumn("invalid_field", invalid_field()).filter(F.col("invalid_field").isNotNull())


def own_features(requests: DataFrame) -> Column:
    """All features of a request that brings features of its own, which replace those of its fields; else NULL."""
    own = F.col("additional_features")
    place, kind = place_feature(F.col("location_name")), type_feature(F.col("crime_type"))
    count = F.col(COUNT_FEATURE).cast("double")
    fields = F.create_map(F.lit(COUNT_FEATURE), count, place, F.lit(1.0), kind, F.lit(1.0))
    return F.when(F.size(own) > 0, merged_features(fields, own))


def score_requests(requests: DataFrame, model: Model) -> DataFrame:
    """One answer per valid request, told apart by request_id.

    A request's additional features replace features of the model by name; other names do not matter to it.
    """
    own = own_features(requests)
    columns = (F.col(COUNT_FEATURE), F.col("location_name"), F.col("crime_type"), F.map_keys(own), F.map_values(own))
    answered = with_scores(valid_requests(requests), model, model.forest.raw_score(*columns))
    return answered.select(
        "request_id", "location_name", "crime_type", "anomaly_score", "is_anomaly", "raw_score", "decision"
    )
