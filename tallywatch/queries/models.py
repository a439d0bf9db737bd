"""Features, training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.scores import (
    COUNT_FEATURE, is_outlier, label, place_feature, rescaled, type_feature,
)
from tallywatch.functions.times import day_of
from tallywatch.operators import day_states
from tallywatch.operators import features as ops
from tallywatch.operators.forest import TREES, fit_forest
from tallywatch.operators.quantile import exact_quantile
from tallywatch.operators.scoring import invalid_requests, own_features, score_counts
from tallywatch.operators.scoring import score_requests as answer
from tallywatch.plans import training
from tallywatch.queries import forest_sql, sql, views
from tallywatch.queries.registry import query
from tallywatch.schema import HOURLY, HOURLY_KEY
from tallywatch.session import new_folder, remove_folder
from tallywatch.sinks.commits import read_committed
from tallywatch.sinks.tables import append, materialize, replace_days
from tallywatch.sources.tables import read_table, stream_score_requests
from tallywatch.streaming import jobs

KEY = ", ".join(HOURLY_KEY)
ANSWER = (
    "request_id long, location_name string, crime_type string, anomaly_score double, is_anomaly boolean, raw_score double, "
    "decision double"
)

SPARSE = f"""{sql.HOURLY}, sparse AS (
  SELECT {KEY}, '{COUNT_FEATURE}' AS feature, incident_count::DOUBLE AS value FROM hourly
  UNION ALL SELECT {KEY}, 'location_' || location_name, 1.0 FROM hourly
  UNION ALL SELECT {KEY}, 'crime_' || crime_type, 1.0 FROM hourly)"""


@query(f"WITH {SPARSE} SELECT * FROM sparse")
def features_onehot(spark, sf_dir):
    """Count, place and type of every row as features with their values; what is not there is 0."""
    return ops.sparse_features(views.hourly_table(spark, sf_dir), *HOURLY_KEY)


@query(f"""WITH {SPARSE}, n AS (SELECT count(*) AS n FROM hourly), fitted AS (
  SELECT feature, sum(value) / any_value(n) AS mean,
         sqrt(greatest(sum(value * value) / any_value(n) - (sum(value) / any_value(n)) ** 2, 0)) AS std
  FROM sparse, n GROUP BY feature)
SELECT {KEY}, feature, round((value - mean) / CASE WHEN std = 0 THEN 1 ELSE std END, 6) + 0.0 AS value
FROM sparse JOIN fitted USING (feature)""")
def features_scaled(spark, sf_dir):
    """The same features after (x - mean) / deviation, mean and deviation taken over all rows."""
    hourly = views.hourly_table(spark, sf_dir)
    scaled = ops.scaled_features(hourly, ops.fit_scaler(hourly), *HOURLY_KEY)
    return scaled.withColumn("value", F.round("value", 6) + F.lit(0.0))


_SCALER = f"""WITH {sql.HOURLY}, n AS (SELECT count(*) AS n FROM hourly), shares AS (
  SELECT 'location_' || location_name AS feature, count(*) / (SELECT n FROM n) AS p FROM hourly GROUP BY ALL
  UNION ALL SELECT 'crime_' || crime_type, count(*) / (SELECT n FROM n) FROM hourly GROUP BY ALL),
fitted AS (
  SELECT feature, p AS mean, sqrt(p * (1 - p)) AS std FROM shares
  UNION ALL SELECT 'incident_count', avg(incident_count), stddev_pop(incident_count) FROM hourly)
SELECT feature, round(mean, 6) AS mean, round(CASE WHEN std = 0 THEN 1 ELSE std END, 6) AS std FROM fitted"""


@query(_SCALER)
def scaler_fit(spark, sf_dir):
    scaler = ops.fit_scaler(views.hourly_table(spark, sf_dir))
    return scaler.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(f"""WITH {sql.REQUESTS}
SELECT request_id, CASE WHEN request_id % 50 = 0 THEN 0 ELSE incident_count END AS incident_count FROM requests""")
def features_fillna(spark, sf_dir):
    """Counts of which some are missing, as features."""
    lost = F.col("request_id") % 50 == 0
    holed = views.requests(spark, sf_dir).withColumn("incident_count", F.when(~lost, F.col("incident_count")))
    return ops.filled(holed).select("request_id", "incident_count")


@query(f"""WITH {sql.HOURLY}
SELECT DISTINCT 'location_' || location_name AS feature FROM hourly
UNION ALL SELECT DISTINCT 'crime_' || crime_type FROM hourly""")
def feature_names(spark, sf_dir):
    return ops.vocabulary(views.unified(spark, sf_dir))


@query(f"""WITH {sql.HOURLY}, {sql.REQUESTS}
SELECT request_id, incident_count,
       CASE WHEN location_name IN (SELECT location_name FROM hourly) THEN 'location_' || location_name END AS place_column,
       CASE WHEN crime_type IN (SELECT crime_type FROM hourly) THEN 'crime_' || crime_type END AS type_column
FROM requests""")
def feature_alignment(spark, sf_dir):
    """Model columns that each request switches on; places the model has not seen switch on none."""
    vocabulary = ops.vocabulary(views.unified(spark, sf_dir))
    model_features = materialize(vocabulary, new_folder(spark, "vocabulary"))
    return ops.aligned(views.requests(spark, sf_dir), model_features).select(
        "request_id", "incident_count", "place_column", "type_column"
    )


@query(f"""WITH {sql.REQUESTS}
SELECT request_id, CAST(incident_count AS DOUBLE) AS merged_count, 1.0::DOUBLE AS merged_place,
       CASE WHEN extra IS NULL THEN 1.0 ELSE extra END AS merged_type,
       CASE WHEN extra IS NULL THEN 3 ELSE 4 END::BIGINT AS n_features, extra
FROM requests""")
def feature_map_merge(spark, sf_dir):
    """A request's own features over the derived ones: one new name, and one that replaces its type's value."""
    requests = views.requests(spark, sf_dir)
    place, kind = place_feature(F.col("location_name")), type_feature(F.col("crime_type"))
    extra = F.try_element_at("additional_features", F.lit("extra"))
    own = F.when(extra.isNotNull(), F.create_map(F.lit("extra"), extra, kind, extra))
    requests = requests.withColumn("additional_features", own)
    merged = requests.withColumn("features", own_features(requests))
    plain = F.create_map(F.lit(COUNT_FEATURE), F.col("incident_count").cast("double"), place, F.lit(1.0), kind, F.lit(1.0))
    merged = merged.withColumn("features", F.coalesce("features", plain))

    def value(name):
        return F.try_element_at("features", name)

    return merged.select(
        "request_id", value(F.lit(COUNT_FEATURE)).alias("merged_count"), value(place).alias("merged_place"),
        value(kind).alias("merged_type"), F.size("features").cast("bigint").alias("n_features"),
        value(F.lit("extra")).alias("extra"),
    )


@query(f"""WITH {sql.SCORED}
SELECT event_id, CASE WHEN anomaly_score > 0.2 THEN 1.0 ELSE 0.0 END::DOUBLE AS normalized_score,
       anomaly_score > 0.2 AS is_anomaly
FROM scored""")
def normalize_score(spark, sf_dir):
    """Labels -1 and 1 as scores 1.0 and 0.0, and as flags."""
    scored = views.events(spark, sf_dir).select("event_id", F.least(F.col("value") / 500, F.lit(1.0)).alias("score"))
    labels = scored.withColumn("label", label(F.lit(0.2) - F.col("score")))
    return labels.select(
        "event_id", rescaled(F.col("label")).alias("normalized_score"), is_outlier(F.col("label")).alias("is_anomaly")
    )


@query(f"""WITH {sql.SCORED}
SELECT round(quantile_cont(anomaly_score, 0.05), 9) AS threshold FROM scored""")
def contamination_quantile(spark, sf_dir):
    threshold = exact_quantile(views.scored(spark, sf_dir), "anomaly_score", training.CONTAMINATION)
    return spark.createDataFrame([(threshold,)], "threshold double").select(F.round("threshold", 9).alias("threshold"))


@query(f"""WITH {sql.REQUESTS}
SELECT request_id, crime_type, incident_count, 'location_name' AS invalid_field FROM requests WHERE request_id % 50 = 0""")
def score_requests_invalid(spark, sf_dir):
    return invalid_requests(views.dirty_requests(spark, sf_dir)).select(
        "request_id", "crime_type", "incident_count", "invalid_field"
    )


_NODE_TABLE = f"""WITH {forest_sql.NODES}
SELECT tree_id::INTEGER AS tree_id, node_id::INTEGER AS node_id, depth::INTEGER AS depth, feature, threshold,
       CASE WHEN feature IS NOT NULL THEN 2 * node_id END::INTEGER AS left_id,
       CASE WHEN feature IS NOT NULL THEN 2 * node_id + 1 END::INTEGER AS right_id, n_rows
FROM nodes"""


@query(_NODE_TABLE)
def iforest_fit(spark, sf_dir):
    """Node table of a forest grown on the hourly counts."""
    return fit_forest(ops.filled(views.hourly_table(spark, sf_dir))).table(spark)


def _trained_by_days(spark, sf_dir) -> training.Training:
    """All days but the last put together first, then the last one added: the state of a day is computed from its rows
    alone, and the training reads states."""
    folder, state = new_folder(spark, "hourly"), new_folder(spark, "day-states")
    replace_days(views.hourly(spark, sf_dir).withColumn("day", day_of(F.col("window_start"))), folder)
    hourly = read_table(spark, folder)
    days = sorted(r["day"] for r in hourly.select("day").distinct().collect())
    for some in (days[:-1], days[-1:]):
        day_states.add_days(spark, hourly, state, some)
    return training.train_by_days(spark, state)


@query(_NODE_TABLE)
def iforest_fit_by_day(spark, sf_dir):
    """The node table of a training that was put together day by day; it is that of a training over all rows."""
    return _trained_by_days(spark, sf_dir).model.forest.table(spark)


@query(f"""WITH {forest_sql.METRICS}
SELECT n_rows::BIGINT AS n_rows, n_anomalies::BIGINT AS n_anomalies, anomaly_ratio, start AS model_offset FROM metrics, model""")
def train_metrics_by_day(spark, sf_dir):
    """Number of rows, outliers and the offset of that training."""
    run = _trained_by_days(spark, sf_dir)
    return training.train_metrics(spark, run).withColumn("model_offset", F.lit(run.model.offset))


@query(_SCALER)
def scaler_fit_by_day(spark, sf_dir):
    """The scaler of that training."""
    scaler = _trained_by_days(spark, sf_dir).scaler
    return scaler.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def _trained(spark, sf_dir) -> tuple[DataFrame, training.Training]:
    hourly = views.hourly_table(spark, sf_dir)
    return hourly, training.train(hourly)


@query(f"""WITH {forest_sql.SCORED_HOURLY}
SELECT {KEY}, incident_count, raw_score, decision FROM scored_hourly""")
def iforest_decision(spark, sf_dir):
    hourly, run = _trained(spark, sf_dir)
    return score_counts(hourly, run.model).select(*HOURLY_KEY, "incident_count", "raw_score", "decision")


@query(f"WITH {forest_sql.SCORED_HOURLY} SELECT {KEY}, incident_count, label FROM scored_hourly")
def iforest_predict(spark, sf_dir):
    hourly, run = _trained(spark, sf_dir)
    return score_counts(hourly, run.model).select(*HOURLY_KEY, "incident_count", "label")


@query(f"WITH {forest_sql.SCORED_HOURLY} SELECT * FROM scored_hourly")
def score_hourly(spark, sf_dir):
    """The hourly table with all its scores."""
    hourly, run = _trained(spark, sf_dir)
    return score_counts(hourly, run.model)


@query(f"WITH {forest_sql.METRICS} SELECT * FROM metrics")
def train_metrics(spark, sf_dir):
    return training.train_metrics(spark, _trained(spark, sf_dir)[1])


@query(f"""WITH {forest_sql.METRICS}
SELECT 'param' AS kind, 'model_type' AS key, 'IsolationForest' AS value
UNION ALL SELECT 'param', 'n_estimators', '{TREES}'
UNION ALL SELECT 'param', 'contamination', '{training.CONTAMINATION}'
UNION ALL SELECT 'metric', 'n_anomalies', CAST(n_anomalies AS VARCHAR) FROM metrics
UNION ALL SELECT 'metric', 'anomaly_ratio', CAST(anomaly_ratio AS VARCHAR) FROM metrics""")
def run_log(spark, sf_dir):
    """Parameters and metrics of a run, appended to the run log and read back; the run's random id is left out."""
    _, run = _trained(spark, sf_dir)
    folder = new_folder(spark, "runs")
    training.save_run(spark, run, folder)
    return spark.read.parquet(folder).drop("run_id")


@query(f"""WITH {sql.HOURLY}
SELECT {KEY}, incident_count, TRUE AS same_scores FROM hourly""")
def model_save_load_roundtrip(spark, sf_dir):
    """Hourly rows with whether the saved and reloaded model scores them as the trained one does."""
    hourly, run = _trained(spark, sf_dir)
    root = new_folder(spark, "model")
    training.save_model(spark, run, root)
    loaded = training.load_latest(spark, root, default_path=f"{root}/none")
    before = score_counts(hourly, run.model).withColumnsRenamed({"raw_score": "raw_before", "decision": "decision_before"})
    both = score_counts(before, loaded)
    same = (F.col("raw_score") == F.col("raw_before")) & (F.col("decision") == F.col("decision_before"))
    return both.select(*HOURLY_KEY, "incident_count", same.alias("same_scores"))


@query(f"""WITH {forest_sql.ANSWERS}
SELECT request_id, location_name, crime_type, anomaly_score, is_anomaly, raw_score, decision FROM answers""")
def score_batch(spark, sf_dir):
    """An answer for every valid request."""
    _, run = _trained(spark, sf_dir)
    return answer(views.dirty_requests(spark, sf_dir), run.model)


@query(f"WITH {forest_sql.SCORED_HOURLY} SELECT * FROM scored_hourly")
def stream_score(spark, sf_dir):
    """The hourly table scored as a stream."""
    folder, out, checkpoint = (new_folder(spark, label) for label in ("hourly", "scores", "checkpoint"))
    views.hourly(spark, sf_dir).write.parquet(folder)
    run = training.train(spark.read.parquet(folder))
    counts = spark.readStream.schema(HOURLY).parquet(folder)
    jobs.start_scores(counts, run.model, out, checkpoint, trigger=jobs.ONCE).awaitTermination()
    return spark.read.parquet(out)


def _answered(spark, sf_dir, table: str, schema: str) -> DataFrame:
    """A table of the job that answers requests, two batches of them, the second of which Spark runs twice because it lost its
    own note of it."""
    _, run = _trained(spark, sf_dir)
    folder, out, checkpoint = (new_folder(spark, label) for label in ("requests", "answered", "checkpoint"))
    requests = views.dirty_requests(spark, sf_dir)
    early = F.col("request_id") < F.lit(requests.count() // 2)
    for number, part in enumerate((early, ~early)):
        append(requests.filter(part), folder, "json")
        for _ in range(1 + number):
            jobs.start_answers(stream_score_requests(spark, folder), run.model, out, checkpoint, jobs.ONCE).awaitTermination()
            remove_folder(spark, f"{checkpoint}/commits/1")
    return read_committed(spark, out, schema, table=table)


@query(f"""WITH {forest_sql.ANSWERS}
SELECT request_id, location_name, crime_type, anomaly_score, is_anomaly, raw_score, decision FROM answers""")
def stream_answers(spark, sf_dir):
    """The answers of a stream of requests."""
    return _answered(spark, sf_dir, jobs.ANSWERS, ANSWER)


@query(f"""WITH {sql.REQUESTS}
SELECT request_id, crime_type, incident_count, 'location_name' AS invalid_field FROM requests WHERE request_id % 50 = 0""")
def stream_rejects(spark, sf_dir):
    """Its requests that have no answer."""
    return _answered(spark, sf_dir, jobs.REJECTS, "request_id long, crime_type string, incident_count long, invalid_field string")
