"""SQL of the views, for use as common table expressions."""

from __future__ import annotations

SOURCE = """CASE user_id % 5 WHEN 0 THEN 'uk_police' WHEN 1 THEN 'chicago' WHEN 2 THEN 'nyc'
    WHEN 3 THEN 'la' ELSE 'other' END"""
PLACE = "'D' || (user_id % 10)"
EPOCH = "CAST(floor(epoch(ts)) AS BIGINT)"
SECOND = "date_trunc('second', ts)"
COUNT = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
KNOWN = "source IN ('uk_police', 'chicago', 'nyc', 'la')"

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
ORDERS_AS_OF = "TIMESTAMP '1998-03-15 00:00:00'"

MESSAGES = f"""messages AS (
  SELECT *, {SOURCE} AS source, {EPOCH} AS "timestamp", {SECOND} AS event_time,
         {PLACE} AS location_name, event_type AS crime_type
  FROM events)"""

ROUTED = f"""{MESSAGES}, routed AS (SELECT * FROM messages WHERE {KNOWN})"""

HOURLY = f"""{ROUTED}, hourly AS (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
         source, location_name, crime_type, count(*) AS incident_count
  FROM routed GROUP BY ALL)"""

CLOSED = f"""{HOURLY}, closed AS (
  SELECT * FROM hourly
  WHERE window_end <= (SELECT max(event_time) FROM routed) - INTERVAL 1 HOUR)"""

SCORED = f"""scored AS (
  SELECT event_id, {PLACE} AS location_name, event_type AS crime_type, ts AS "timestamp",
         {COUNT} AS incident_count, least(value / 500, 1.0) AS anomaly_score
  FROM events)"""


def picked(days: int) -> str:
    """One place and type of scored over the last days."""
    return f"""{SCORED}, picked AS (
  SELECT *, anomaly_score > 0.2 AS is_anomaly FROM scored
  WHERE location_name = 'D1' AND crime_type = 'view' AND "timestamp" > {AS_OF} - INTERVAL {days} DAY)"""


REQUESTS = f"""requests AS (
  SELECT event_id AS request_id, {PLACE} AS location_name, event_type AS crime_type,
         {COUNT} AS incident_count, CASE WHEN event_id % 3 = 0 THEN value END AS extra
  FROM events)"""

CITIES = """cities(lat, lng, city) AS (VALUES
  (CAST(51.5074 AS DECIMAL(9,4)), CAST(-0.1278 AS DECIMAL(9,4)), 'London'),
  (52.4862, -1.8904, 'Birmingham'), (53.4808, -2.2426, 'Manchester'),
  (55.9533, -3.1883, 'Edinburgh'), (53.8008, -1.5491, 'Leeds'))"""


def point(user: str, axis: str) -> str:
    values = {"lat": ("51.5074", "52.4862", "53.4808", "55.9533", "53.8008"),
              "lng": ("-0.1278", "-1.8904", "-2.2426", "-3.1883", "-1.5491")}[axis]
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CAST(CASE {user} % 6 {whens} ELSE 0 END AS DECIMAL(9,4))"


POINTS = f"""{CITIES}, points AS (
  SELECT event_id, {SOURCE} AS source, {point('user_id', 'lat')} AS lat, {point('user_id', 'lng')} AS lng
  FROM events)"""
