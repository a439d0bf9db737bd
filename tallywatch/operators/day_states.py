"""What a training needs to know of a day of hourly counts, kept so that days can be put together.

The state of a day is two tables, partitioned by day:

    draws          per tree the rows of the day with the lowest draws. The lowest draws of several days are among the
                   lowest of each, so together they hold the sample that a training over all rows would draw.
    combinations   number of rows per place, type and count. A score depends on nothing else, so these give the scores
                   of all rows with their numbers, and exact moments of all features.

Draws are at most trees * per_tree rows a day however many rows the day has. A state is computed from its day alone, and
computing it again replaces it.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.functions.scores import COUNT_FEATURE
from tallywatch.operators.features import sparse_features
from tallywatch.operators.forest import DRAWS, MAX_SAMPLES, OVERSAMPLING, SEED, TREES, hashed_rows, tree_draws
from tallywatch.schema import HOURLY_KEY
from tallywatch.sinks.tables import replace_days

COMBINATION = ("location_name", "crime_type", COUNT_FEATURE)
ROWS = "n"


def of_days(hourly: DataFrame, days: Iterable[date]) -> DataFrame:
    """Rows of some days; on a table partitioned by day no other folder is read."""
    return hourly.filter(F.col("day").isin(*days))


def day_combinations(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("day", *COMBINATION).agg(F.count("*").alias(ROWS))


def day_draws(hourly: DataFrame, trees: int, per_tree: int, seed: int, oversampling: int = OVERSAMPLING) -> DataFrame:
    """Per day and tree the rows of lowest draw. Rows whose draw is above a bound, which leaves about oversampling * per_tree
    of them per day, are dropped before they are repeated for the trees."""
    # One row per day.
    sizes = hourly.groupBy("day").agg(F.count("*").alias("rows_of_day"))
    bound = F.least(F.lit(1.0), F.lit(oversampling * per_tree) / F.col("rows_of_day")) * DRAWS
    hashed = hashed_rows(hourly, seed, HOURLY_KEY, "day").join(F.broadcast(sizes), "day")
    drawn = tree_draws(hashed, trees, bound.cast("bigint")).drop("rows_of_day")
    order = Window.partitionBy("day", "tree_id").orderBy("draw", *HOURLY_KEY)
    return drawn.withColumn("place_in_draw", F.row_number().over(order)).filter(F.col("place_in_draw") <= per_tree)


def short_days(spark: SparkSession, state: str, days: Iterable[date], trees: int, per_tree: int) -> list[date]:
    """Days whose trees have fewer draws than there are rows to draw."""
    rows = of_days(combinations(spark, state), days).groupBy("day").agg(F.sum(ROWS).alias("rows"))
    held = of_days(draws(spark, state), days).groupBy("day").agg(F.count("*").alias("held"))
    wanted = F.least(F.col("rows"), F.lit(per_tree)) * trees
    return [r["day"] for r in rows.join(held, "day", "left").filter(F.coalesce("held", F.lit(0)) < wanted).collect()]


def add_days(
    spark: SparkSession, hourly: DataFrame, state: str, days: Iterable[date],
    trees: int = TREES, max_samples: int = MAX_SAMPLES, seed: int = SEED, oversampling: int = OVERSAMPLING,
) -> None:
    """Compute the states of some days of `hourly`, a table partitioned by day, of which no other day is read.

    A day without rows has no state. Missing counts are 0.
    """
    days = list(days)
    if not days:
        return
    rows = of_days(hourly, days).na.fill(0, [COUNT_FEATURE])
    replace_days(day_combinations(rows), f"{state}/combinations")
    while days:
        replace_days(day_draws(of_days(rows, days), trees, max_samples, seed, oversampling).drop("place_in_draw"), f"{state}/draws")
        # A bound that leaves a tree short of rows is next to impossible, but the tree would be another.
        days = short_days(spark, state, days, trees, max_samples)
        oversampling *= 8


def draws(spark: SparkSession, state: str) -> DataFrame:
    return spark.read.parquet(f"{state}/draws")


def combinations(spark: SparkSession, state: str) -> DataFrame:
    return spark.read.parquet(f"{state}/combinations")


def merged(combinations: DataFrame) -> DataFrame:
    """Combinations of several days together."""
    return combinations.groupBy(*COMBINATION).agg(F.sum(ROWS).alias(ROWS))


def scaler_of(combinations: DataFrame) -> DataFrame:
    """What features.fit_scaler gives for the rows, from exact sums of their counts and of the squares."""
    exact = "decimal(38,0)"
    per_feature = sparse_features(combinations, ROWS).groupBy("feature").agg(
        F.sum(ROWS).alias("present"),
        F.sum(F.col("value").cast(exact) * F.col(ROWS)).cast(exact).alias("total"),
        F.sum((F.col("value").cast("decimal(18,0)") * F.col("value").cast("decimal(18,0)")).cast(exact)
              * F.col(ROWS)).cast(exact).alias("squares"),
    )
    rows = per_feature.filter(F.col("feature") == COUNT_FEATURE).select("present").scalar().cast(exact)
    total, squares = F.col("total"), F.col("squares")
    spread = F.sqrt((rows * squares - total * total).cast("double")) / rows
    fitted = per_feature.select("feature", (total.cast("double") / rows).alias("mean"), spread.alias("std"))
    fitted = fitted.withColumn("std", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))
    return fitted.withColumn("absent", -F.col("mean") / F.col("std"))
