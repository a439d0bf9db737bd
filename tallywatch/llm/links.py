"""Classes of linked documents by rounds of joins; nothing but a count reaches the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallywatch.session import new_folder, remove_folder


def stored(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again: it survives lost executors and cuts the lineage."""
    folder = new_folder(spark, label)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A `stored` whose tables are removed at the end of the block; what is to outlive it must be stored by then."""
    folders = []

    def keep(frame: DataFrame, label: str) -> DataFrame:
        folder = new_folder(spark, label)
        folders.append(folder)
        frame.write.parquet(folder)
        return spark.read.schema(frame.schema).parquet(folder)

    try:
        yield keep
    finally:
        for folder in folders:
            remove_folder(spark, folder)


def classes(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(id, class) of all ids that `links` (a, b) connect with others; the class is the smallest id of the group.

    Every round points each id to its smallest neighbour, follows these pointers to their ends, and goes on with the
    links between different ends only. Pointers go down and are followed two steps at a time, so both loops take a number of
    turns that follows a logarithm, and the links left shrink from round to round. Ids with many links meet in partial
    aggregates.
    """
    with scratch(spark) as keep:
        low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        links = keep(links.filter("a != b").select(low, high).distinct(), "links")
        found = None
        while found is None or not links.isEmpty():
            ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
            ends = links.select(F.explode(ways).alias("e"))
            ends = ends.groupBy(F.col("e.a").alias("id")).agg(F.min("e.b").alias("near"))
            points = keep(ends.select("id", F.least("id", "near").alias("class")), "points")
            while True:
                on = points.select(F.col("id").alias("class"), F.col("class").alias("end"))
                moved = Observation()
                step = points.join(on, "class").observe(moved, F.count_if(F.col("end") < F.col("class")).alias("n"))
                points = keep(step.select("id", F.col("end").alias("class")), "points")
                if not moved.get["n"]:
                    break
            further = points.select(F.col("id").alias("class"), F.col("class").alias("end"))
            found = points if found is None else found.join(further, "class", "left").select(
                "id", F.coalesce("end", "class").alias("class"))
            for side in ("a", "b"):
                end = points.select(F.col("id").alias(side), F.col("class").alias(f"{side}_end"))
                links = links.join(end, side)
            links = links.filter("a_end != b_end").select(
                F.least("a_end", "b_end").alias("a"), F.greatest("a_end", "b_end").alias("b")).distinct()
            links = keep(links, "links")
        return stored(spark, found, "classes")
