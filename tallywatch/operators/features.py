"""Feature columns of hourly counts, and their scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.scores import COUNT_FEATURE, place_feature, type_feature


def filled(counts: DataFrame) -> DataFrame:
    """A missing count is 0."""
    return counts.na.fill(0, [COUNT_FEATURE])


def count_value() -> Column:
    """The count as a feature's value."""
    return F.coalesce(F.col(COUNT_FEATURE), F.lit(0)).cast("double")


def category_structs() -> list[Column]:
    """The one-hot features of a row, whose names are NULL where the row has no place or type."""
    names = (place_feature(F.col("location_name")), type_feature(F.col("crime_type")))
    return [F.struct(name.alias("feature"), F.lit(1.0).alias("value")) for name in names]


def sparse_features(counts: DataFrame, *key: str) -> DataFrame:
    """The non-zero features of each row as (key, feature, value); the count is always present.

    This is the one-hot form without its zeros: it needs no vocabulary and holds at any number of places and types.
    """
    count = F.struct(F.lit(COUNT_FEATURE).alias("feature"), count_value().alias("value"))
    return counts.select(*key, F.inline(F.array(count, *category_structs()))).filter(F.col("feature").isNotNull())


def vocabulary(counts: DataFrame) -> DataFrame:
    """Names of the one-hot features."""
    names = F.array(place_feature(F.col("location_name")), type_feature(F.col("crime_type")))
    return counts.select(F.explode(names).alias("feature")).filter(F.col("feature").isNotNull()).distinct()


def fit_scaler(counts: DataFrame) -> DataFrame:
    """Mean and population deviation per feature, the zeros of one-hot features included, and `absent`, the scaled
    value of the feature in rows that do not have it.

    A one-hot feature with share p has mean p and deviation sqrt(p(1-p)), so counting its rows is enough; how many rows
    there are, the count feature says, which all of them have. A deviation of 0 is stored as 1, which leaves a constant
    feature at 0 after scaling.
    """
    per_feature = sparse_features(counts).groupBy("feature").agg(
        F.count("*").alias("present"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
    )
    is_count = F.col("feature") == COUNT_FEATURE
    share = F.col("present") / per_feature.filter(is_count).select("present").scalar()
    fitted = per_feature.select(
        "feature",
        F.when(is_count, F.col("mean")).otherwise(share).alias("mean"),
        F.when(is_count, F.col("std")).otherwise(F.sqrt(share * (1 - share))).alias("std"),
    ).withColumn("std", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))
    return fitted.withColumn("absent", -F.col("mean") / F.col("std"))


def scaled_features(counts: DataFrame, scaler: DataFrame, *key: str) -> DataFrame:
    """sparse_features after (x - mean) / std. A feature that a row lacks has the scaler's `absent` there.

    Features that the scaler does not know are left out. The count, which every row has, is scaled by two numbers; only
    places and types are joined. Spark broadcasts a scaler that is small enough, and splits hot places otherwise.
    """
    fitted = scaler.select("feature", "mean", "std")
    of_count = fitted.filter(F.col("feature") == COUNT_FEATURE)
    mean, std = (of_count.select(c).scalar() for c in ("mean", "std"))
    count = counts.select(*key, F.lit(COUNT_FEATURE).alias("feature"), ((count_value() - mean) / std).alias("value"))
    named = counts.select(*key, F.inline(F.array(*category_structs()))).filter(F.col("feature").isNotNull())
    scaled = (F.col("value") - F.col("mean")) / F.col("std")
    named = named.join(fitted.filter(F.col("feature") != COUNT_FEATURE), "feature").select(*key, "feature", scaled.alias("value"))
    return named.unionByName(count.filter(F.col("value").isNotNull()))


def aligned(requests: DataFrame, model_features: DataFrame) -> DataFrame:
    """The one-hot features a request switches on in the model; NULL where the model has none for its value.

    model_features should be a stored table, such as the scaler of a saved model. Spark then knows its size:
    below spark.sql.autoBroadcastJoinThreshold the requests are not shuffled at all, above it the joins are
    sort-merge ones in which the adaptive plan splits hot places.
    """
    known = model_features.select("feature")
    places = known.select(F.col("feature").alias("place_column"))
    types = known.select(F.col("feature").alias("type_column"))
    return requests.join(
        places, place_feature(F.col("location_name")) == F.col("place_column"), "left"
    ).join(types, type_feature(F.col("crime_type")) == F.col("type_column"), "left")
