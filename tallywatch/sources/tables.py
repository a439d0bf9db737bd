"""Tables by path, request files and the model registry."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.times import ISO_MICROS
from tallywatch.schema import SCORE_REQUEST, SCORE_REQUEST_TEXT, SCORED

# For writing and reading JSON lines; Spark's default format keeps milliseconds only.
JSON_TIMES = {"timestampNTZFormat": ISO_MICROS}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Current content of a table; fmt may be delta where that connector is installed."""
    return spark.read.format(fmt).load(path)


def read_table_or_empty(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """The same, without rows as long as nobody has written the table."""
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_score_requests(spark: SparkSession, path: str) -> DataFrame:
    """Score requests kept as JSON lines. Numbers may be written as text, and counts with a fraction lose it;
    what is no number becomes NULL, for invalid_requests to find."""
    return _typed_requests(spark.read.schema(SCORE_REQUEST_TEXT).json(path))


def stream_score_requests(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same of a folder into which requests keep coming."""
    return _typed_requests(spark.readStream.schema(SCORE_REQUEST_TEXT).options(**options).json(path))


def _typed_requests(text: DataFrame) -> DataFrame:
    return text.withColumns(
        {
            "incident_count": F.col("incident_count").try_cast("double").try_cast("bigint"),
            "additional_features": F.transform_values("additional_features", lambda _, v: v.try_cast("double")),
        }
    ).select(*SCORE_REQUEST.fieldNames())


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """Scored counts kept as JSON lines."""
    return spark.read.schema(SCORED).options(**JSON_TIMES).json(path)


def latest_versions(registry: DataFrame, default_path: str | None) -> DataFrame:
    """Path of the highest version per model name, or the default where the registry has no path."""
    path: Column = F.coalesce(F.max_by("path", "version"), F.lit(default_path))
    return registry.groupBy("name").agg(F.max("version").alias("version"), path.alias("path"))
