"""Gap-free time series."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.times import instant

STEP = timedelta(hours=6)
STEPS = 28


def time_grid(scored: DataFrame, as_of: datetime, step: timedelta = STEP, steps: int = STEPS) -> DataFrame:
    """incident_count per place, type and step over the steps before as_of, with 0 where nothing was seen.

    Places meet the types that they were ever seen with. The input is read once: it is summed per step, rows outside the
    steps as one more, and the sums of a pair, at most one per step, are looked up for each step.
    """
    start = as_of - step * steps
    length = int(step.total_seconds())
    instants = F.sequence(instant(start), instant(as_of - step), F.make_dt_interval(secs=F.lit(length)))
    # Whole steps since the start, counted in seconds so that any as_of works.
    moment = F.col("timestamp").cast("timestamp_ntz")
    offset = F.timestamp_diff("SECOND", instant(start), moment)
    step_start = F.timestamp_add("SECOND", (F.floor(offset / length) * length).cast("long"), instant(start))
    inside = (moment >= instant(start)) & (moment < instant(as_of))
    sums = (
        scored.filter(F.col("location_name").isNotNull() & F.col("crime_type").isNotNull())
        .groupBy("location_name", "crime_type", F.when(inside, step_start).alias("timestamp"))
        .agg(F.sum(F.when(inside, F.col("incident_count"))).alias("n"))
    )
    seen = F.collect_list(F.when(F.col("timestamp").isNotNull(), F.struct("timestamp", "n")))
    return (
        sums.groupBy("location_name", "crime_type")
        .agg(F.map_from_entries(seen).alias("seen"))
        .withColumn("timestamp", F.explode(instants))
        .select(
            "location_name", "crime_type", "timestamp",
            F.coalesce(F.try_element_at("seen", F.col("timestamp")), F.lit(0)).alias("incident_count"),
        )
    )
