"""From source-shaped envelopes to one common record."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.incidents import crime_type, known_source, place_name, unknown_source
from tallywatch.functions.times import event_time
from tallywatch.schema import SOURCE_NAMES

UNIFIED_COLUMNS = ("source", "timestamp", "event_time", "crime_type", "location_name")


def with_event_time(envelopes: DataFrame) -> DataFrame:
    return envelopes.withColumn("event_time", event_time(F.col("timestamp")))


def routed(envelopes: DataFrame, names: Iterable[str] = SOURCE_NAMES) -> DataFrame:
    """Records of the named sources with their event time and crime type, all own fields kept."""
    return with_event_time(envelopes.filter(known_source(names))).withColumn("crime_type", crime_type())


def quarantine(envelopes: DataFrame) -> DataFrame:
    """What the hourly counts leave out, with the reason: unreadable documents and sources nobody knows, which routing
    drops, and records without a usable event time, which no window takes."""
    reason = F.when(unknown_source(), F.lit("source")).when(event_time(F.col("timestamp")).isNull(), F.lit("event time"))
    return envelopes.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def unify(envelopes: DataFrame) -> DataFrame:
    """The five common columns of every known source, in one pass over the input."""
    return routed(envelopes).withColumn("location_name", place_name()).select(*UNIFIED_COLUMNS)
