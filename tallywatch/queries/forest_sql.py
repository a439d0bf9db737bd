"""The forest in SQL: the same draws, trees and scores, level by level."""

from __future__ import annotations

from tallywatch.functions.scores import COUNT_FEATURE, PLACE_PREFIX, TYPE_PREFIX
from tallywatch.operators.forest import DRAWS, EULER_GAMMA, MAX_SAMPLES, SCORE_DECIMALS, SEED, TREES, depth_limit, multipliers
from tallywatch.plans.training import CONTAMINATION
from tallywatch.queries import sql

KEY = "window_start, source, location_name, crime_type"
DEPTH = depth_limit(MAX_SAMPLES)

_TREES = ", ".join(f"({t}, {', '.join(map(str, multipliers(t)))})" for t in range(TREES))


def _number(text: str, part: int) -> str:
    return f"('0x' || substr(md5({text}), {8 * part + 1}, 8))::BIGINT"


_ROW = f"concat_ws('|', '{SEED}', epoch_us(window_start), source, location_name, crime_type)"
_NODE = f"'{SEED}|' || tree_id || '|' || node_id"

_SAMPLE = f"""{sql.HOURLY}, trees(tree_id, a, b, c, d) AS (VALUES {_TREES}),
numbers AS (SELECT *, {_number(_ROW, 0)} % {DRAWS} AS u, {_number(_ROW, 1)} % {DRAWS} AS v FROM hourly),
draws AS (SELECT tree_id, {KEY}, incident_count, ((u * a + b) % {DRAWS}) * {DRAWS} + (v * c + d) % {DRAWS} AS draw
  FROM numbers, trees),
size AS (SELECT least({MAX_SAMPLES}, count(*)) AS per_tree FROM hourly),
rows_0 AS MATERIALIZED (
  SELECT tree_id, 1 AS node_id, incident_count::DOUBLE AS n, location_name, crime_type
  FROM (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY draw, {KEY}) AS place FROM draws), size
  WHERE place <= per_tree)"""


def _value(feature: str, count: str) -> str:
    return (f"CASE WHEN {feature} = '{COUNT_FEATURE}' THEN {count} WHEN {feature} = '{PLACE_PREFIX}' || location_name "
            f"OR {feature} = '{TYPE_PREFIX}' || crime_type THEN 1.0 ELSE 0.0 END")


def _level(k: int) -> str:
    """Nodes of depth k and the rows of depth k + 1."""
    nodes = f"""nodes_{k} AS MATERIALIZED (
  SELECT tree_id, node_id, count(*) AS n_rows, min(n) AS low, max(n) AS high FROM rows_{k} GROUP BY ALL)"""
    if k == DEPTH:
        return f"""{nodes}, splits_{k} AS (SELECT tree_id, node_id, '' AS feature, 0.0::DOUBLE AS threshold FROM nodes_{k} WHERE FALSE)"""
    one_hot = "\n  UNION ALL ".join(
        f"SELECT tree_id, node_id, '{prefix}' || {column}, 0.0, 1.0 FROM rows_{k} JOIN nodes_{k} USING (tree_id, node_id) "
        f"WHERE {column} IS NOT NULL GROUP BY tree_id, node_id, n_rows, {column} HAVING count(*) < n_rows"
        for prefix, column in ((PLACE_PREFIX, "location_name"), (TYPE_PREFIX, "crime_type")))
    return f"""{nodes}, varying_{k} AS (
  SELECT tree_id, node_id, '{COUNT_FEATURE}' AS feature, low, high FROM nodes_{k} WHERE low < high
  UNION ALL {one_hot}),
ranked_{k} AS (
  SELECT *, row_number() OVER (PARTITION BY tree_id, node_id ORDER BY feature) - 1 AS place,
         count(*) OVER (PARTITION BY tree_id, node_id) AS n FROM varying_{k}),
splits_{k} AS MATERIALIZED (
  SELECT tree_id, node_id, feature, low + ({_number(_NODE, 1)} + 0.5::DOUBLE) / 4294967296.0::DOUBLE * (high - low) AS threshold
  FROM ranked_{k} WHERE place = {_number(_NODE, 0)} % n),
rows_{k + 1} AS MATERIALIZED (
  SELECT tree_id, CASE WHEN {_value('feature', 'n')} <= threshold THEN 2 * node_id ELSE 2 * node_id + 1 END AS node_id,
         n, location_name, crime_type
  FROM rows_{k} JOIN splits_{k} USING (tree_id, node_id))"""


NODES = f"""{_SAMPLE}, {', '.join(_level(k) for k in range(DEPTH + 1))}, nodes AS MATERIALIZED (
  {' UNION ALL '.join(
    f"SELECT tree_id, node_id, {k} AS depth, feature, threshold, n_rows "
    f"FROM nodes_{k} LEFT JOIN splits_{k} USING (tree_id, node_id)" for k in range(DEPTH + 1))})"""


def _mean_path(n: str) -> str:
    return (f"CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 "
            f"ELSE 2.0 * (ln(({n} - 1)::DOUBLE) + {EULER_GAMMA}) - 2.0 * ({n} - 1) / {n} END")


def _scores(name: str, table: str) -> str:
    """A table of the raw score of every combination of count, place and type in another."""
    steps = "".join(f""", {name}_at_{k + 1} AS MATERIALIZED (
  SELECT w.tree_id, w.n, w.location_name, w.crime_type,
         CASE WHEN s.feature IS NULL THEN w.node_id
              WHEN {_value('s.feature', 'w.n').replace('location_name', 'w.location_name').replace('crime_type', 'w.crime_type')}
                   <= s.threshold THEN 2 * w.node_id ELSE 2 * w.node_id + 1 END AS node_id
  FROM {name}_at_{k} w LEFT JOIN nodes s ON s.tree_id = w.tree_id AND s.node_id = w.node_id)""" for k in range(DEPTH))
    return f"""{name}_at_0 AS MATERIALIZED (
  SELECT tree_id, n, location_name, crime_type, 1 AS node_id
  FROM (SELECT DISTINCT coalesce(incident_count, 0)::DOUBLE AS n, location_name, crime_type FROM {table}), trees){steps},
{name} AS MATERIALIZED (
  SELECT n, location_name, crime_type,
         round(-pow(2.0, -avg(depth + {_mean_path('n_rows')}) / (SELECT {_mean_path('per_tree')} FROM size)), {SCORE_DECIMALS})
           AS raw_score
  FROM {name}_at_{DEPTH} w JOIN nodes USING (tree_id, node_id) GROUP BY ALL)"""


_MODEL = f"""{NODES}, {_scores('known', 'hourly')},
raw AS MATERIALIZED (
  SELECT h.*, k.raw_score FROM hourly h JOIN known k
  ON k.n = h.incident_count AND k.location_name = h.location_name AND k.crime_type = h.crime_type),
model AS (SELECT round(quantile_cont(raw_score, {CONTAMINATION}::DOUBLE), {SCORE_DECIMALS}) AS start FROM raw)"""

_LABELLED = f"""SELECT *, CASE WHEN decision < 0 THEN -1 ELSE 1 END::INTEGER AS label,
         CASE WHEN decision < 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS anomaly_score, decision < 0 AS is_anomaly
  FROM (SELECT t.*, round(raw_score - start, {SCORE_DECIMALS}) AS decision FROM {{}} t, model)"""

SCORED_HOURLY = f"{_MODEL}, scored_hourly AS MATERIALIZED ({_LABELLED.format('raw')})"

ANSWERS = f"""{_MODEL}, {sql.REQUESTS}, valid AS (SELECT * FROM requests WHERE request_id % 50 <> 0),
{_scores('asked', 'valid')}, raw_answers AS (
  SELECT v.request_id, v.location_name, v.crime_type, a.raw_score FROM valid v JOIN asked a
  ON a.n = v.incident_count AND a.location_name = v.location_name AND a.crime_type = v.crime_type),
answers AS ({_LABELLED.format('raw_answers')})"""

METRICS = f"""{SCORED_HOURLY}, metrics AS (
  SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = -1) AS n_anomalies,
         (count(*) FILTER (WHERE label = -1))::DOUBLE / count(*) AS anomaly_ratio FROM scored_hourly)"""
