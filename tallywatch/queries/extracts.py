"""Polls of the landing folders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.incidents import crime_type
from tallywatch.queries import sql, views
from tallywatch.queries.registry import query
from tallywatch.schema import CHICAGO, ENVELOPE, LA, NYC, SOURCES, Source
from tallywatch.session import new_folder
from tallywatch.sinks.tables import append
from tallywatch.sources import landing, tables

POLLED_AT = f"CAST(epoch({sql.AS_OF}) AS BIGINT)"


LIMIT = 100


def _recent_sql(source: Source, limit: int | None = None) -> str:
    newest = f"ORDER BY date_trunc('millisecond', ts) DESC, record_id LIMIT {limit}" if limit else ""
    return f"""WITH {sql.ROUTED}
SELECT CAST(event_id AS VARCHAR) AS record_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS happened,
       source, {POLLED_AT} AS "timestamp", crime_type, location_name
FROM routed
WHERE source = '{source.name}' AND date_trunc('millisecond', ts) > {sql.AS_OF} - INTERVAL 7 DAY {newest}"""


def _recent(spark, sf_dir, source: Source, limit: int | None = None) -> DataFrame:
    found = landing.extract_recent(spark, views.landing(spark, sf_dir), source, views.AS_OF, limit=limit)
    return found.select(
        F.col(source.id_field).alias("record_id"), F.col(source.date_field).alias("happened"), "source", "timestamp",
        F.col(source.type_field).alias("crime_type"), F.col(source.place_field).alias("location_name"),
    )


@query(_recent_sql(CHICAGO))
def extract_chicago(spark, sf_dir):
    return _recent(spark, sf_dir, CHICAGO)


@query(_recent_sql(NYC))
def extract_nyc(spark, sf_dir):
    return _recent(spark, sf_dir, NYC)


@query(_recent_sql(LA))
def extract_la(spark, sf_dir):
    return _recent(spark, sf_dir, LA)


@query(_recent_sql(CHICAGO, LIMIT))
def extract_limited(spark, sf_dir):
    """The newest records of one agency, as many as the caller asks for."""
    return _recent(spark, sf_dir, CHICAGO, LIMIT)


@query(f"""WITH {sql.CITIES}, polled AS (
  SELECT *, {sql.point('o_custkey', 'lat')} AS lat, {sql.point('o_custkey', 'lng')} AS lng FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS category, '1998-02' AS month, city AS location_name,
       'uk_police' AS source, CAST(epoch({sql.ORDERS_AS_OF}) AS BIGINT) AS "timestamp"
FROM polled JOIN cities USING (lat, lng)
WHERE o_orderdate >= TIMESTAMP '1998-02-01' AND o_orderdate < TIMESTAMP '1998-03-01'""")
def extract_uk(spark, sf_dir):
    """Last month at the five polled places; other places are left unread."""
    found = landing.extract_uk(spark, views.uk_landing(spark, sf_dir), views.ORDERS_AS_OF)
    return found.select("id", "category", "month", "location_name", "source", "timestamp")


@query(f"""WITH {sql.ROUTED}
SELECT CAST(event_id AS VARCHAR) AS id, source, {POLLED_AT} AS "timestamp", crime_type
FROM routed WHERE source <> 'nyc'""")
def extract_tolerant(spark, sf_dir):
    """Every agency's landing folder, one of which is not there."""
    root = views.landing(spark, sf_dir)
    reads = []
    for source in SOURCES:
        folder = landing.source_folder(root, source) if source != NYC else f"{root}/missing"
        found = landing.read_or_empty(spark, [folder], ENVELOPE, folder).select(*ENVELOPE.fieldNames())
        reads.append(landing.tagged(found, source, views.AS_OF))
    return reduce(DataFrame.unionByName, reads).select("id", "source", "timestamp", crime_type().alias("crime_type"))


@query(f"""WITH {sql.SCORED}
SELECT location_name, crime_type, "timestamp", incident_count, anomaly_score, anomaly_score > 0.2 AS is_anomaly
FROM scored""")
def scored_json_roundtrip(spark, sf_dir):
    """Scored counts written as JSON lines and read by schema."""
    folder = new_folder(spark, "scored-json")
    scored = views.scored(spark, sf_dir).withColumn("is_anomaly", F.col("anomaly_score") > 0.2)
    append(scored, folder, "json", **tables.JSON_TIMES)
    return tables.read_scored(spark, folder)


@query(f"""WITH {sql.REQUESTS}
SELECT request_id, location_name, crime_type, incident_count, extra FROM requests""")
def score_requests_parse(spark, sf_dir):
    """Requests as JSON lines, optional feature map included."""
    folder = new_folder(spark, "requests")
    append(views.requests(spark, sf_dir), folder, "json")
    return tables.read_score_requests(spark, folder).select(
        "request_id", "location_name", "crime_type", "incident_count",
        F.try_element_at("additional_features", F.lit("extra")).alias("extra"),
    )


@query("""SELECT p_brand AS name, max(p_partkey) AS version, coalesce(arg_max(p_name, p_partkey), 'models/default') AS path
FROM part GROUP BY p_brand""")
def latest_model_version(spark, sf_dir):
    return tables.latest_versions(views.registry(spark, sf_dir), "models/default")
