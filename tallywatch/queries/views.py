"""Views that give the test tables the shape of incident data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.times import ISO_MILLIS, MONTH_KEY
from tallywatch.operators.aggregates import hourly_counts
from tallywatch.operators.normalize import unify
from tallywatch.schema import CITIES, SOURCES, UK
from tallywatch.session import new_folder
from tallywatch.sinks.messages import to_messages
from tallywatch.sinks.tables import materialize
from tallywatch.sources.messages import parse_narrow

AS_OF = datetime(2024, 1, 31)
ORDERS_AS_OF = datetime(1998, 3, 15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def place(user_id: str = "user_id") -> Column:
    return F.concat(F.lit("D"), F.col(user_id) % 10)


def source() -> Column:
    """Agency of an event; the fifth kind belongs to no agency, and routing must drop it."""
    names = F.array(*[F.lit(s.name) for s in SOURCES], F.lit("other"))
    return F.element_at(names, (F.col("user_id") % 5 + 1).cast("int"))


def epoch(ts: str = "ts") -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def coordinates(user_id: str) -> tuple[Column, Column]:
    """One of the five polled points, or (0, 0)."""
    kind = (F.col(user_id) % (len(CITIES) + 1) + 1).cast("int")
    lat, lng = ([*(c[i] for c in CITIES), 0] for i in (0, 1))
    return tuple(
        F.element_at(F.array(*[F.lit(str(v)) for v in axis]), kind).cast("decimal(9,4)") for axis in (lat, lng)
    )


def source_records(spark: SparkSession, sf_dir: str, some: DataFrame | None = None) -> DataFrame:
    """Events, or some of them, under the field names of their agency. to_json leaves out what is NULL."""
    known = F.col("source") != "other"
    of = {s.name: F.col("source") == s.name for s in SOURCES}
    own_fields = {}
    for s in SOURCES:
        own_fields[s.type_field] = F.when(of[s.name], F.col("event_type"))
        own_fields[s.place_field] = F.when(of[s.name], place())
        own_fields[s.id_field] = F.when(known if s == UK else of[s.name], F.col("event_id").cast("string"))
        pattern = MONTH_KEY if s == UK else ISO_MILLIS
        own_fields[s.date_field] = F.when(of[s.name], F.date_format("ts", pattern))
    street = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name"))
    latitude = F.col("value").cast("decimal(18,2)").cast("string").alias("latitude")
    location = F.when(of["uk_police"] | of["chicago"], F.struct(latitude, street.alias("street")))
    return (
        (events(spark, sf_dir) if some is None else some)
        .withColumn("source", source())
        .select("source", epoch().alias("timestamp"), location.alias("location"),
                *[column.alias(name) for name, column in own_fields.items()])
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_messages(source_records(spark, sf_dir))


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unify(parse_narrow(raw_messages(spark, sf_dir)))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_counts(unified(spark, sf_dir))


def hourly_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hourly as the table that training and scoring read."""
    return materialize(hourly(spark, sf_dir), new_folder(spark, "hourly"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        place().alias("location_name"),
        F.col("event_type").alias("crime_type"),
        F.col("ts").alias("timestamp"),
        F.get_json_object("props", "$.k").cast("bigint").alias("incident_count"),
        F.least(F.col("value") / 500, F.lit(1.0)).alias("anomaly_score"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = F.create_map(F.lit("extra"), F.col("value"))
    return events(spark, sf_dir).select(
        F.col("event_id").alias("request_id"),
        place().alias("location_name"),
        F.col("event_type").alias("crime_type"),
        F.get_json_object("props", "$.k").cast("bigint").alias("incident_count"),
        F.when(F.col("event_id") % 3 == 0, extra).alias("additional_features"),
    )


def dirty_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """requests in which some rows have lost their place."""
    lost = F.col("request_id") % 50 == 0
    return requests(spark, sf_dir).withColumn("location_name", F.when(~lost, F.col("location_name")))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lng = coordinates("user_id")
    return events(spark, sf_dir).select("event_id", source().alias("source"), lat.alias("lat"), lng.alias("lng"))


def write_landing(documents: DataFrame, path: str, *folders: str) -> None:
    """Write documents below one folder per value. Ranges of equal size that end in the text itself give each
    task few folders to write to and share a folder that holds much among several tasks."""
    documents.repartitionByRange(*folders, "value").write.mode("append").partitionBy(*folders).text(path)


def land(records: DataFrame, folder: str) -> None:
    """Write records of source_records into a landing folder, by source and day."""
    body = F.struct(*[name for name in records.columns if name != "source"])
    day = F.timestamp_seconds("timestamp").cast("date")
    write_landing(records.select(F.to_json(body).alias("value"), "source", day.alias("day")), folder, "source", "day")


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Landing folder with the raw messages of each source, by day."""
    folder = new_folder(spark, "landing")
    land(source_records(spark, sf_dir), folder)
    return folder


def land_events(spark: SparkSession, sf_dir: str, folder: str, condition: Column) -> None:
    """Land the events of a condition: those of the UK as records of the month before, at the place they were polled at."""
    some = events(spark, sf_dir).filter(condition)
    land(source_records(spark, sf_dir, some).filter(F.col("source") != UK.name), folder)
    lat, lng = coordinates("user_id")
    document = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("category")))
    month = F.date_format(F.add_months("ts", -1), MONTH_KEY)
    uk = some.filter(source() == UK.name).select(document.alias("value"), lat.alias("lat"), lng.alias("lng"), month.alias("month"))
    write_landing(uk, f"{folder}/source={UK.name}", "lat", "lng", "month")


def uk_landing(spark: SparkSession, sf_dir: str) -> str:
    """Landing folder in which every order is a UK record, by the place it was polled at and by month."""
    folder = new_folder(spark, "landing-uk")
    lat, lng = coordinates("o_custkey")
    document = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("o_orderpriority").alias("category"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        document.alias("value"), lat.alias("lat"), lng.alias("lng"), F.date_format("o_orderdate", MONTH_KEY).alias("month")
    )
    write_landing(orders, f"{folder}/source={UK.name}", "lat", "lng", "month")
    return folder


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("name"), F.col("p_partkey").alias("version"), F.col("p_name").alias("path")
    )


def without_zone(frame: DataFrame) -> DataFrame:
    """Timestamps as UTC wall time, the form the SQL results have."""
    zoned = [name for name, kind in frame.dtypes if kind == "timestamp"]
    return frame.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})
