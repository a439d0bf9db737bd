"""Coordinates to place names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.schema import CITIES, CITY_SCHEMA, UNKNOWN_CITY


def with_city(points: DataFrame, name: str, cities: Iterable[tuple] = CITIES) -> DataFrame:
    """Add the place polled at exactly (lat, lng), or Unknown; both columns are DECIMAL(9,4).

    The cities are those a poll asks for one by one, a list in the driver's hands, so broadcasting it is safe at any
    size of points.
    """
    known = points.sparkSession.createDataFrame(list(cities), CITY_SCHEMA)
    return (
        points.join(F.broadcast(known), ["lat", "lng"], "left")
        .withColumn(name, F.coalesce("city", F.lit(UNKNOWN_CITY)))
        .drop("city")
    )
