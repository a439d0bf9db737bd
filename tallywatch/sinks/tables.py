"""Append to and replace tables by path."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append(frame: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    frame.write.format(fmt).options(**options).mode("append").save(path)


def replace_days(frame: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a table partitioned by day; days that the frame has replace those of the table, others stay.

    Repeating a job therefore leaves one copy of its rows.
    """
    writer = frame.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").save(path)


def materialize(frame: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write a table and return it as read back, so that later steps start from files and not from lineage."""
    frame.write.format(fmt).mode("errorifexists").save(path)
    return frame.sparkSession.read.format(fmt).load(path)
