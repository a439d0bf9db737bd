"""Poll the landing folders and publish what they hold."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tallywatch.schema import CITIES, SOURCES, UK, UNKNOWN_CITY
from tallywatch.sinks.messages import publish
from tallywatch.sources.landing import extract


@dataclass
class Polled:
    """Records sent, in total, per source and per city, and what went wrong with the sources that failed."""

    counts: dict[str, int]
    failed: dict[str, str] = field(default_factory=dict)


def poll(
    spark: SparkSession, landing: str, as_of: datetime, fmt: str = "kafka", path: str | None = None,
    limit: int | None = None, cities: Iterable[tuple] = CITIES, **options: str,
) -> Polled:
    """Publish one poll of every agency. Records are counted while they pass.

    Every agency is a write of its own: one whose folders cannot be read sends nothing and stops nobody else.
    """
    cities = list(cities)
    names = [*(city for _, _, city in cities), UNKNOWN_CITY]
    polled = Polled(dict.fromkeys(["total", *(s.name for s in SOURCES), *names], 0))
    for source in SOURCES:
        sent = Observation()
        per_city = [F.count_if(F.col("location_name") == name).alias(name) for name in names] if source == UK else []
        try:
            records = extract(spark, landing, source, as_of, limit=limit, cities=cities)
            publish(records.observe(sent, F.count("*").alias(source.name), *per_city), fmt, path, **options)
        except (PySparkException, Py4JJavaError) as problem:
            polled.failed[source.name] = str(problem)
            continue
        for name, n in sent.get.items():
            polled.counts[name] += n
        polled.counts["total"] += sent.get[source.name]
    return polled
