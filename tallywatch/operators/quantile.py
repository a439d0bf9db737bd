"""Exact quantiles without sorting the data or holding it in one place."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.session import new_folder, remove_folder
from tallywatch.sinks.tables import materialize

BUCKETS = 1024
FEW = 10_000


@contextmanager
def value_counts(frame: DataFrame, column: str, times: str | None = None) -> Iterator[DataFrame]:
    """Table of (value, n) for the finite values; it is removed at the end of the block.

    A row counts once, or as often as its column `times` says. NULL, NaN and the infinities have no place in a rank and
    are set aside.
    """
    value = F.col(column).cast("double")
    finite = frame.filter(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))))
    counts = finite.groupBy(value.alias("value")).agg((F.sum(times) if times else F.count("*")).alias("n"))
    folder = new_folder(frame.sparkSession, "value-counts")
    try:
        yield materialize(counts, folder)
    finally:
        remove_folder(frame.sparkSession, folder)


def quantile_of_counts(counts: DataFrame, q: float, buckets: int = BUCKETS, few: int = FEW) -> float | None:
    """Linearly interpolated quantile of the values in a (value, n) table; None when there are none.

    While too many values are left to look at, a histogram of their range tells which bucket holds the rank,
    and that bucket's own minimum and maximum are the next range. The driver sees at most `buckets` rows per
    pass, and at the end at most `few` values.
    """
    value = F.col("value")
    total, low, high, distinct = counts.agg(F.sum("n"), F.min(value), F.max(value), F.count("*")).first()
    if not total:
        return None
    position = q * (total - 1)
    rank = int(position)
    part = position - rank
    while distinct > few and low < high:
        # Halves, as the difference of two doubles may be none.
        share = (value / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
        before = distinct
        histogram = (
            counts.filter(value.between(low, high))
            .groupBy(F.least(F.floor(share * buckets), F.lit(buckets - 1)).alias("bucket"))
            .agg(F.sum("n").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"),
                 F.count("*").alias("distinct"))
            .orderBy("bucket")
        )
        for bucket in histogram.collect():
            if rank < bucket["n"]:
                low, high, distinct = bucket["low"], bucket["high"], bucket["distinct"]
                break
            rank -= bucket["n"]
        if distinct == before:
            raise ValueError(f"values from {low} to {high} cannot be told apart by ranges")

    left = counts.filter(value.between(low, high)).select("value", "n").orderBy("value").collect()
    here = 0
    while rank >= left[here]["n"]:
        rank -= left[here]["n"]
        here += 1
    found = left[here]["value"]
    if part == 0 or rank + 1 < left[here]["n"]:
        return found
    if here + 1 < len(left):
        following = left[here + 1]["value"]
    else:
        following = counts.filter(value > found).agg(F.min(value)).first()[0]
    return found + (following - found) * part


def exact_quantile(frame: DataFrame, column: str, q: float) -> float | None:
    with value_counts(frame, column) as counts:
        return quantile_of_counts(counts, q)
