"""Train, log, save and load the anomaly model."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.operators import day_states
from tallywatch.operators.features import filled, fit_scaler
from tallywatch.operators.forest import MAX_SAMPLES, SCORE_DECIMALS, SEED, TREES, Forest, fit_forest, grow_forest, lowest_draws
from tallywatch.operators.quantile import quantile_of_counts, value_counts
from tallywatch.operators.scoring import Model
from tallywatch.schema import MODEL_NAME
from tallywatch.sinks.commits import create_file
from tallywatch.sinks.tables import append
from tallywatch.sources.tables import latest_versions, read_table, read_table_or_empty

CONTAMINATION = 0.05

RUN_LOG_SCHEMA = "run_id string, kind string, key string, value string"
REGISTRY_SCHEMA = "name string, version long, path string"
STATE_SCHEMA = "per_tree int, offset double, contamination double, seed long"


@dataclass(frozen=True)
class Training:
    """Outcome of one run. scaler is a DataFrame: its rows grow with the vocabulary."""

    run_id: str
    model: Model
    scaler: DataFrame
    n_rows: int
    n_anomalies: int

    @property
    def anomaly_ratio(self) -> float | None:
        return self.n_anomalies / self.n_rows if self.n_rows else None


def train(hourly: DataFrame, contamination: float = CONTAMINATION, trees: int = TREES, seed: int = SEED) -> Training:
    """Fit on a table of hourly counts. It is read to count, to draw, to score and, when the scaler is used, for that; a
    frame that is no stored table should be written first, or its lineage is paid for each time.

    Scores are kept as a table of distinct values with their number of rows, as long as the offset and the number of
    outliers are not known; both come from it.
    """
    counts = filled(hourly)
    forest = fit_forest(counts, trees=trees, seed=seed)
    return _judged(forest, counts, None, fit_scaler(counts), contamination, seed)


def train_by_days(
    spark: SparkSession, state: str, contamination: float = CONTAMINATION, trees: int = TREES,
    max_samples: int = MAX_SAMPLES, seed: int = SEED, since: date | None = None,
) -> Training:
    """The training of `train` over all days that `state` knows, or those from `since` on, without reading their rows.

    What is read are the lowest draws of each day and its combinations of place, type and count; trees, seed and
    max_samples must be those the states were computed with.
    """
    recent = F.lit(True) if since is None else F.col("day") >= F.lit(since)
    combinations = day_states.merged(day_states.combinations(spark, state).filter(recent))
    n_rows = combinations.agg(F.sum(day_states.ROWS)).first()[0]
    if not n_rows:
        raise ValueError("no rows to train on")
    per_tree = min(max_samples, n_rows)
    sample = lowest_draws(day_states.draws(spark, state).filter(recent), trees, per_tree)
    forest = grow_forest(sample, per_tree, seed)
    return _judged(forest, combinations, day_states.ROWS, day_states.scaler_of(combinations), contamination, seed)


def _judged(
    forest: Forest, counts: DataFrame, times: str | None, scaler: DataFrame, contamination: float, seed: int
) -> Training:
    """Offset and outliers of a forest over its rows, of which each stands for as many as `times` says."""
    raw_score = forest.raw_score(F.col("incident_count"), F.col("location_name"), F.col("crime_type"))
    scored = counts.select(raw_score.alias("raw_score"), *([times] if times else []))
    with value_counts(scored, "raw_score", times) as scores:
        offset = quantile_of_counts(scores, contamination)
        offset = offset if offset is None else round(offset, SCORE_DECIMALS)
        below = F.when(F.col("value") - F.lit(offset) < 0, F.col("n")).otherwise(F.lit(0))
        n_rows, n_anomalies = scores.agg(F.sum("n"), F.sum(below)).first()
    return Training(uuid.uuid4().hex, Model(forest, offset, contamination, seed), scaler, n_rows, n_anomalies)


def train_metrics(spark: SparkSession, run: Training) -> DataFrame:
    return spark.createDataFrame(
        [(run.n_rows, run.n_anomalies, run.anomaly_ratio)],
        "n_rows long, n_anomalies long, anomaly_ratio double",
    )


def run_log(spark: SparkSession, run: Training) -> DataFrame:
    """Parameters and metrics of a run as rows."""
    params = {
        "model_type": "IsolationForest",
        "n_estimators": int(run.model.forest.nodes["tree_id"].nunique()),
        "contamination": run.model.contamination,
    }
    metrics = {"n_anomalies": run.n_anomalies, "anomaly_ratio": run.anomaly_ratio}
    rows = [(run.run_id, "param", key, str(value)) for key, value in params.items()]
    rows += [(run.run_id, "metric", key, str(value)) for key, value in metrics.items()]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def save_run(spark: SparkSession, run: Training, path: str, fmt: str = "parquet") -> None:
    append(run_log(spark, run), path, fmt)


def save_model(spark: SparkSession, run: Training, root: str, name: str = MODEL_NAME, fmt: str = "parquet") -> str:
    """Write nodes, scaler and state below root, then register the next version. The registry row comes
    last, so a job that dies earlier leaves no half-written version behind.

    A version number is claimed by a file that only one job can create, so trainers may run at the same time: each gets
    a number of its own. A job that dies between its claim and its row leaves a number that no model has.
    """
    path = f"{root}/models/{name}-{run.run_id}"
    model = run.model
    append(model.forest.table(spark), f"{path}/nodes", fmt)
    append(run.scaler, f"{path}/scaler", fmt)
    state = [(model.forest.per_tree, model.offset, model.contamination, model.seed)]
    append(spark.createDataFrame(state, STATE_SCHEMA), f"{path}/state", fmt)
    version = claim_version(spark, root, name, path, fmt)
    # Every row is a folder of its own: two jobs that append to one folder would share their temporary files.
    append(spark.createDataFrame([(path,)], "path string"), f"{root}/registry/name={name}/version={version}", fmt)
    return path


def claim_version(spark: SparkSession, root: str, name: str, path: str, fmt: str = "parquet") -> int:
    """The next version number that nobody has claimed, claimed for the model at `path`."""
    version = 1 + (registered(spark, root, name, fmt).agg(F.max("version")).first()[0] or 0)
    while not create_file(spark, f"{root}/versions/{name}/{version:09d}", path):
        version += 1
    return version


def registered(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Registered versions of a model as (name, version, path)."""
    table = read_table_or_empty(spark, f"{root}/registry", REGISTRY_SCHEMA, fmt)
    return table.select(F.col("name").cast("string"), F.col("version").cast("bigint"), "path").filter(F.col("name") == name)


def load_model(spark: SparkSession, path: str, fmt: str = "parquet") -> Model:
    state = read_table(spark, f"{path}/state", fmt).first()
    nodes = read_table(spark, f"{path}/nodes", fmt).orderBy("tree_id", "node_id").toPandas()
    return Model(Forest(nodes, state["per_tree"]), state["offset"], state["contamination"], state["seed"])


def load_latest(
    spark: SparkSession, root: str, default_path: str | None = None, name: str = MODEL_NAME, fmt: str = "parquet"
) -> Model:
    """The latest registered version, or the model at default_path when none is registered."""
    latest = latest_versions(registered(spark, root, name, fmt), default_path).first()
    path = latest["path"] if latest else default_path
    if path is None:
        raise ValueError(f"no model {name} is registered below {root}, and no default was given")
    return load_model(spark, path, fmt)
