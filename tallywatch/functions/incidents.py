"""Expressions over the message envelope."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywatch.schema import SOURCE_NAMES, SOURCES, Source


def per_source(pick) -> Column:
    """CASE source WHEN ... over the known sources; pick maps a Source to a column."""
    first, *rest = SOURCES
    case = F.when(F.col("source") == first.name, pick(first))
    for source in rest:
        case = case.when(F.col("source") == source.name, pick(source))
    return case


def crime_type() -> Column:
    return per_source(lambda s: F.col(s.type_field))


def place_name() -> Column:
    return per_source(lambda s: F.col(s.place_field))


def record_id() -> Column:
    """The id that the agency has given the record."""
    return per_source(lambda s: F.col(s.id_field))


def known_source(names: Iterable[str] = SOURCE_NAMES) -> Column:
    return F.col("source").isin(*names)


def unknown_source() -> Column:
    return F.col("source").isNull() | ~known_source()


def is_from(source: Source) -> Column:
    return F.col("source") == source.name


def source_counts() -> list[Column]:
    """Aggregates that count records in total and per known source."""
    return [F.count("*").alias("total"), *(F.count_if(is_from(s)).alias(s.name) for s in SOURCES)]


def map_value(column: str, key: str) -> Column:
    return F.try_element_at(F.col(column), F.lit(key))


def nested_value(column: str, key: str, path: str) -> Column:
    """Field of an object that the map keeps as raw JSON text."""
    return F.get_json_object(map_value(column, key), path)
