"""Extracts from a landing folder of JSON lines.

    source=<agency>/day=<date of the record>/          agencies polled for the last days
    source=uk_police/lat=<..>/lng=<..>/month=<..>/     polled per place for a month

The folders carry what a poll asks for, so a poll opens those it needs and no others.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions.times import epoch_seconds, newer_than, previous_month_key
from tallywatch.operators.cities import with_city
from tallywatch.schema import CITIES, CITY_SCHEMA, ENVELOPE, SOURCES, UK, UK_FIELDS, Source

LOOKBACK = timedelta(days=7)

DAILY_LANDING = T.StructType([*ENVELOPE.fields, T.StructField("day", T.DateType())])
UK_LANDING = T.StructType([*ENVELOPE.fields, *CITY_SCHEMA.fields[:2]])


def source_folder(root: str, source: Source) -> str:
    return f"{root}/source={source.name}"


def read_or_empty(spark: SparkSession, paths: list[str], schema: T.StructType, base: str) -> DataFrame:
    """JSON lines below the paths in one read; a path that is not there yields no rows and stops nobody else."""
    try:
        return spark.read.schema(schema).option("basePath", base).json(paths)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
    if len(paths) == 1:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [read_or_empty(spark, [path], schema, base) for path in paths])


def tagged(records: DataFrame, source: Source, as_of: datetime) -> DataFrame:
    """Stamp source and poll time over whatever the record says about them."""
    return records.withColumns({"source": F.lit(source.name), "timestamp": epoch_seconds(as_of)})


def day_folders(folder: str, as_of: datetime, age: timedelta) -> list[str]:
    """Folders of the days from as_of - age to the day after as_of, which clocks ahead of ours may have begun."""
    first, last = (as_of - age).date(), as_of.date() + timedelta(days=1)
    return [f"{folder}/day={first + timedelta(days=n)}" for n in range((last - first).days + 1)]


def extract_recent(
    spark: SparkSession, root: str, source: Source, as_of: datetime,
    age: timedelta = LOOKBACK, limit: int | None = None,
) -> DataFrame:
    """Records strictly newer than as_of - age to the second; with a limit the newest of them, newest first.

    The order is total (date, then the agency's own id), so a limit that bites always keeps the same rows. Only the
    folders of the days asked for are listed.
    """
    folder = source_folder(root, source)
    happened = F.col(source.date_field).try_cast("timestamp_ntz")
    recent = read_or_empty(spark, day_folders(folder, as_of, age), DAILY_LANDING, folder).filter(
        newer_than(happened, as_of.replace(microsecond=0), age)
    )
    if limit is not None:
        recent = recent.orderBy(happened.desc(), F.col(source.id_field)).limit(limit)
    return tagged(recent.drop("day"), source, as_of)


def extract_uk(spark: SparkSession, root: str, as_of: datetime, cities: Iterable[tuple] = CITIES) -> DataFrame:
    """Last month's records of the polled cities, under their names; the folders of other places are not opened."""
    folder, cities = source_folder(root, UK), list(cities)
    paths = [f"{folder}/lat={lat}/lng={lng}" for lat, lng, _ in cities]
    month = read_or_empty(spark, paths, UK_LANDING, folder).filter(F.col("month") == previous_month_key(as_of))
    # An unreadable line has nothing but what its folder says.
    said = [name for name in UK_FIELDS if name != "month"]
    placed = with_city(month.dropna("all", subset=said).drop("location_name"), "location_name", cities)
    return tagged(placed, UK, as_of).select(*ENVELOPE.fieldNames())


def extract(
    spark: SparkSession, root: str, source: Source, as_of: datetime, age: timedelta = LOOKBACK,
    limit: int | None = None, cities: Iterable[tuple] = CITIES,
) -> DataFrame:
    """One poll of an agency."""
    if source == UK:
        return extract_uk(spark, root, as_of, cities)
    return extract_recent(spark, root, source, as_of, age, limit).select(*ENVELOPE.fieldNames())


def extract_all(
    spark: SparkSession, root: str, as_of: datetime, age: timedelta = LOOKBACK, limit: int | None = None
) -> DataFrame:
    """One poll of every agency."""
    return reduce(DataFrame.unionByName, [extract(spark, root, source, as_of, age, limit) for source in SOURCES])
