"""Messages, envelopes and unified records."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tallywatch.functions.incidents import map_value, nested_value
from tallywatch.functions.times import (
    ISO_SECONDS, MONTH_KEY, in_previous_month, newer_than, previous_month_key,
)
from tallywatch.operators.aggregates import ingest_counts as count_ingested
from tallywatch.operators.cities import with_city
from tallywatch.operators.normalize import routed, unify, with_event_time
from tallywatch.queries import sql, views
from tallywatch.queries.registry import query
from tallywatch.schema import SOURCES, UK
from tallywatch.session import new_folder
from tallywatch.sinks.messages import publish
from tallywatch.sources.landing import tagged
from tallywatch.sources.messages import parse, read_messages
from tallywatch.sources.tables import read_table


def _envelopes(spark, sf_dir):
    return parse(views.raw_messages(spark, sf_dir))


@query(f"""WITH {sql.MESSAGES}
SELECT source, "timestamp",
       CASE WHEN source <> 'other' THEN CAST(event_id AS VARCHAR) END AS id,
       CASE WHEN source = 'uk_police' THEN crime_type END AS category,
       CASE WHEN source = 'uk_police' THEN location_name END AS location_name,
       CASE WHEN source = 'uk_police' THEN strftime(ts, '%Y-%m') END AS month,
       CASE WHEN source = 'chicago' THEN crime_type END AS primary_type,
       CASE WHEN source = 'chicago' THEN location_name END AS district,
       CASE WHEN source = 'nyc' THEN crime_type END AS ofns_desc,
       CASE WHEN source = 'nyc' THEN location_name END AS boro_nm,
       CASE WHEN source = 'la' THEN crime_type END AS crm_cd_desc,
       CASE WHEN source = 'la' THEN location_name END AS area_name,
       CAST(NULL AS VARCHAR) AS vict_age
FROM messages""")
def parse_envelope(spark, sf_dir):
    """JSON text to the full envelope; fields a source does not send are NULL."""
    return _envelopes(spark, sf_dir).select(
        "source", "timestamp", "id", "category", "location_name", "month", "primary_type", "district",
        "ofns_desc", "boro_nm", "crm_cd_desc", "area_name", "vict_age",
    )


@query(f"""WITH {sql.MESSAGES}
SELECT CASE WHEN source <> 'other' THEN CAST(event_id AS VARCHAR) END AS id, source, "timestamp", event_time
FROM messages""")
def event_time_cast(spark, sf_dir):
    return with_event_time(_envelopes(spark, sf_dir)).select("id", "source", "timestamp", "event_time")


@query(f"""WITH {sql.ROUTED}
SELECT source, CAST(event_id AS VARCHAR) AS id, event_time FROM routed""")
def route_by_source(spark, sf_dir):
    return routed(_envelopes(spark, sf_dir)).select("source", "id", "event_time")


@query(f"""WITH {sql.ROUTED}
SELECT CAST(event_id AS VARCHAR) AS id, source, crime_type FROM routed""")
def derive_crime_type(spark, sf_dir):
    return routed(_envelopes(spark, sf_dir)).select("id", "source", "crime_type")


@query(f"""WITH {sql.ROUTED}
SELECT source, "timestamp", event_time, crime_type, location_name FROM routed""")
def normalize_columns(spark, sf_dir):
    """Full envelopes projected to the common columns."""
    return unify(_envelopes(spark, sf_dir))


@query(f"""WITH {sql.ROUTED}
SELECT source, "timestamp", event_time, crime_type, location_name FROM routed""")
def unify_sources(spark, sf_dir):
    """The same rows from the narrow parse, as the hourly job reads them."""
    return views.unified(spark, sf_dir)


@query(f"""WITH {sql.HOURLY}
SELECT * FROM hourly""")
def hourly_counts(spark, sf_dir):
    return views.hourly(spark, sf_dir)


@query(f"""WITH {sql.HOURLY}
SELECT * FROM hourly""")
def table_snapshot_read(spark, sf_dir):
    """The hourly table written to a path and read by path."""
    folder = new_folder(spark, "snapshot")
    views.hourly(spark, sf_dir).write.parquet(folder)
    return read_table(spark, folder)


@query(f"""WITH {sql.ROUTED}
SELECT CAST(event_id AS VARCHAR) AS id, source,
       CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS latitude,
       CAST(user_id AS VARCHAR) AS street_id, crime_type AS street_name
FROM routed WHERE source IN ('uk_police', 'chicago')""")
def map_field_access(spark, sf_dir):
    """Plain and nested values of the location map."""
    located = _envelopes(spark, sf_dir).filter(F.col("location").isNotNull())
    return located.select(
        "id", "source", map_value("location", "latitude").alias("latitude"),
        nested_value("location", "street", "$.id").alias("street_id"),
        nested_value("location", "street", "$.name").alias("street_name"),
    )


@query(f"""WITH {sql.MESSAGES}
SELECT source, "timestamp", CAST(event_id AS VARCHAR) AS id, crime_type,
       CASE WHEN source = 'uk_police' THEN location_name END AS location_name
FROM messages WHERE {sql.KNOWN}""")
def messages_to_json(spark, sf_dir):
    """Records published as JSON lines and read back."""
    folder = new_folder(spark, "topic")
    publish(views.source_records(spark, sf_dir), "text", folder)
    return routed(parse(read_messages(spark, "text", folder))).select(
        "source", "timestamp", "id", "crime_type", "location_name"
    )


@query(f"""WITH {sql.POINTS}
SELECT event_id, CAST(lat AS DOUBLE) AS lat, CAST(lng AS DOUBLE) AS lng, coalesce(city, 'Unknown') AS location_name
FROM points LEFT JOIN cities USING (lat, lng)""")
def location_lookup(spark, sf_dir):
    placed = with_city(views.points(spark, sf_dir), "location_name")
    return placed.select("event_id", F.col("lat").cast("double"), F.col("lng").cast("double"), "location_name")


@query(f"""WITH {sql.POINTS}
SELECT event_id, 'uk_police' AS source, CAST(epoch({sql.AS_OF}) AS BIGINT) AS "timestamp",
       coalesce(city, 'Unknown') AS location_name
FROM points LEFT JOIN cities USING (lat, lng)""")
def envelope_enrich(spark, sf_dir):
    """Source, poll time and place stamped over whatever the records carried."""
    placed = with_city(views.points(spark, sf_dir), "location_name")
    return tagged(placed, UK, views.AS_OF).select("event_id", "source", "timestamp", "location_name")


@query(f"""WITH {sql.POINTS}, records AS (
  SELECT source, CASE WHEN source = 'uk_police' THEN coalesce(city, 'Unknown') END AS city
  FROM points LEFT JOIN cities USING (lat, lng) WHERE {sql.KNOWN})
SELECT 'total' AS scope, 'all' AS name, count(*) AS records FROM records
UNION ALL SELECT 'source', source, count(*) FROM records GROUP BY source
UNION ALL SELECT 'city', city, count(*) FROM records WHERE city IS NOT NULL GROUP BY city""")
def ingest_counts(spark, sf_dir):
    known = views.points(spark, sf_dir).filter(F.col("source").isin([s.name for s in SOURCES]))
    return count_ingested(with_city(known, "location_name"))


@query(f"""SELECT event_id, ts, event_type FROM events WHERE ts > {sql.AS_OF} - INTERVAL 7 DAY""")
def lookback_7d(spark, sf_dir):
    recent = newer_than(F.col("ts"), views.AS_OF, timedelta(days=7))
    return views.events(spark, sf_dir).filter(recent).select("event_id", "ts", "event_type")


@query(f"""SELECT o_orderkey, o_orderdate, '1998-02' AS month FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = strftime(date_trunc('month', {sql.ORDERS_AS_OF}) - INTERVAL 1 DAY, '%Y-%m')""")
def previous_month_filter(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    return orders.filter(in_previous_month(F.col("o_orderdate"), views.ORDERS_AS_OF)).select(
        "o_orderkey", "o_orderdate", F.lit(previous_month_key(views.ORDERS_AS_OF)).alias("month")
    )


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso_second, strftime(ts, '%Y-%m') AS month
FROM events""")
def format_timestamps(spark, sf_dir):
    return views.events(spark, sf_dir).select(
        "event_id",
        F.date_format("ts", ISO_SECONDS).alias("iso_second"),
        F.date_format("ts", MONTH_KEY).alias("month"),
    )


@query("""SELECT o_orderkey, date_trunc('month', o_orderdate)::TIMESTAMP AS month_start,
  strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y-%m') AS month_before,
  o_orderdate - INTERVAL 7 DAY AS week_before, o_orderdate - INTERVAL 24 HOUR AS day_before,
  o_orderdate - INTERVAL 3 DAY AS three_days_before
FROM orders""")
def date_arithmetic(spark, sf_dir):
    day = F.col("o_orderdate")
    first = F.date_trunc("month", day)
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        first.cast("timestamp_ntz").alias("month_start"),
        F.date_format(F.date_sub(first, 1), MONTH_KEY).alias("month_before"),
        (day - F.expr("INTERVAL 7 DAYS")).alias("week_before"),
        (day - F.expr("INTERVAL 24 HOURS")).alias("day_before"),
        (day - F.expr("INTERVAL 3 DAYS")).alias("three_days_before"),
    )
