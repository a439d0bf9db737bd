"""Reporting queries."""

from __future__ import annotations


from tallywatch.operators import grid
from tallywatch.operators import reports as ops
from tallywatch.queries import sql, views
from tallywatch.queries.registry import query

PLACE, TYPE = "D1", "view"


def _picked(spark, sf_dir, time_range: str = "7d"):
    return ops.in_range(ops.for_place_and_type(views.scored(spark, sf_dir), PLACE, TYPE), views.AS_OF, time_range)


COLUMNS = 'location_name, crime_type, "timestamp", incident_count, anomaly_score'


@query(f"""WITH {sql.SCORED}
SELECT {COLUMNS} FROM scored WHERE location_name = 'D1' AND crime_type = 'view'""")
def report_filter(spark, sf_dir):
    return ops.for_place_and_type(views.scored(spark, sf_dir), PLACE, TYPE)


@query(f"WITH {sql.picked(1)} SELECT {COLUMNS} FROM picked")
def report_last_24h(spark, sf_dir):
    return _picked(spark, sf_dir, "24h")


@query(f"WITH {sql.picked(3)} SELECT {COLUMNS} FROM picked")
def report_last_3d(spark, sf_dir):
    return _picked(spark, sf_dir, "3d")


@query(f"WITH {sql.picked(7)} SELECT {COLUMNS} FROM picked")
def report_last_7d(spark, sf_dir):
    return _picked(spark, sf_dir, "7d")


@query(f"WITH {sql.SCORED} SELECT {COLUMNS}, anomaly_score > 0.2 AS is_anomaly FROM scored")
def anomaly_flag(spark, sf_dir):
    return ops.flagged(views.scored(spark, sf_dir))


@query(f"WITH {sql.picked(7)} SELECT {COLUMNS}, is_anomaly FROM picked WHERE is_anomaly")
def anomaly_points(spark, sf_dir):
    return ops.anomalies(_picked(spark, sf_dir))


@query(f'WITH {sql.picked(7)} SELECT "timestamp", incident_count FROM picked ORDER BY "timestamp"')
def incident_series(spark, sf_dir):
    return ops.series(_picked(spark, sf_dir))


@query(f"""WITH {sql.SCORED}
SELECT crime_type, CAST(sum(incident_count) AS BIGINT) AS incident_count
FROM scored WHERE location_name = 'D1' AND crime_type IS NOT NULL GROUP BY crime_type""")
def type_distribution(spark, sf_dir):
    return ops.type_distribution(views.scored(spark, sf_dir), PLACE)


@query(f"""WITH {sql.picked(7)}, totals AS (
  SELECT CAST(coalesce(sum(incident_count), 0) AS BIGINT) AS total_incidents,
         CAST(coalesce(sum(incident_count) FILTER (WHERE is_anomaly), 0) AS BIGINT) AS anomalous_incidents
  FROM picked)
SELECT total_incidents, anomalous_incidents,
       CASE WHEN total_incidents > 0
            THEN floor(anomalous_incidents / total_incidents * 100 * 100 + 0.5) / 100 ELSE 0 END AS anomaly_percentage,
       CAST(0.2 AS DOUBLE) AS threshold
FROM totals""")
def anomaly_metrics(spark, sf_dir):
    return ops.anomaly_metrics(_picked(spark, sf_dir))


@query(f"""WITH {sql.SCORED}
SELECT bin, bin / 20.0::DOUBLE AS bin_start, count(*) AS n
FROM (SELECT CAST(floor(least(anomaly_score * 20, 19)) AS BIGINT) AS bin FROM scored WHERE anomaly_score IS NOT NULL)
GROUP BY bin""")
def score_histogram(spark, sf_dir):
    return ops.score_histogram(views.scored(spark, sf_dir))


@query(f"""WITH {sql.picked(7)}
SELECT strftime("timestamp", '%Y-%m-%d %H:%M') AS "timestamp", incident_count,
       floor(anomaly_score * 100 + 0.5) / 100 AS anomaly_score
FROM (SELECT * FROM picked WHERE is_anomaly
      ORDER BY "timestamp" DESC, incident_count DESC, anomaly_score DESC LIMIT 5)""")
def recent_anomalies(spark, sf_dir):
    return ops.recent_anomalies(_picked(spark, sf_dir))


@query(f"WITH {sql.SCORED} SELECT DISTINCT location_name FROM scored ORDER BY location_name")
def distinct_locations(spark, sf_dir):
    return ops.options(views.scored(spark, sf_dir), "location_name")


@query(f"WITH {sql.SCORED} SELECT DISTINCT crime_type FROM scored ORDER BY crime_type")
def distinct_crime_types(spark, sf_dir):
    return ops.options(views.scored(spark, sf_dir), "crime_type")


@query(f"""WITH {sql.SCORED}, spine AS (
  SELECT location_name, crime_type, "timestamp"
  FROM (SELECT DISTINCT location_name, crime_type FROM scored),
       (SELECT unnest(generate_series({sql.AS_OF} - INTERVAL 7 DAY, {sql.AS_OF} - INTERVAL 6 HOUR, INTERVAL 6 HOUR))
          AS "timestamp")),
sums AS (
  SELECT location_name, crime_type, time_bucket(INTERVAL 6 HOUR, "timestamp", {sql.AS_OF}) AS "timestamp",
         CAST(sum(incident_count) AS BIGINT) AS incident_count
  FROM scored WHERE "timestamp" >= {sql.AS_OF} - INTERVAL 7 DAY AND "timestamp" < {sql.AS_OF} GROUP BY ALL)
SELECT location_name, crime_type, "timestamp", coalesce(incident_count, 0) AS incident_count
FROM spine LEFT JOIN sums USING (location_name, crime_type, "timestamp")""")
def time_grid_fill(spark, sf_dir):
    return grid.time_grid(views.scored(spark, sf_dir), views.AS_OF)
