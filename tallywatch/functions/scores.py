"""Expressions over labels, scores and feature names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COUNT_FEATURE = "incident_count"
PLACE_PREFIX = "location_"
TYPE_PREFIX = "crime_"

DEFAULT_THRESHOLD = 0.2


def place_feature(place: Column) -> Column:
    return F.concat(F.lit(PLACE_PREFIX), place)


def type_feature(crime_type: Column) -> Column:
    return F.concat(F.lit(TYPE_PREFIX), crime_type)


def label(decision: Column) -> Column:
    """-1 for an outlier, 1 otherwise; a decision of exactly 0 is no outlier."""
    return F.when(decision < 0, F.lit(-1)).otherwise(F.lit(1))


def rescaled(label_column: Column) -> Column:
    """Label -1/1 to 1.0/0.0, where 1 is anomalous."""
    return 1 - (label_column + 1) / F.lit(2.0)


def is_outlier(label_column: Column) -> Column:
    return label_column < 0


def above(score: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    return score > F.lit(float(threshold))


def two_decimals(value: Column) -> Column:
    """Numeric rounding, the same in every engine; text formatting differs on exact halves."""
    return F.floor(value * 100 + F.lit(0.5)) / F.lit(100.0)


def merged_features(base: Column, extras: Column) -> Column:
    """base with the request's own features put over it."""
    kept = F.map_filter(base, lambda name, _: ~F.map_contains_key(extras, name))
    return F.when(extras.isNull(), base).otherwise(F.map_concat(kept, extras))
