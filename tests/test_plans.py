"""Shapes of the physical plans that scale depends on."""

from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tallywatch.__main__ import days_of
from tallywatch.functions.times import day_of, on_report_days
from tallywatch.operators.aggregates import hourly_counts
from tallywatch.operators.features import fit_scaler, scaled_features
from tallywatch.operators.forest import draw_samples
from tallywatch.operators.grid import time_grid
from tallywatch.operators.normalize import unify
from tallywatch.operators.reports import anomaly_metrics, for_place_and_type, in_range
from tallywatch.operators.scoring import score_counts
from tallywatch.plans.training import train
from tallywatch.queries import views
from tallywatch.queries.catalog import QUERIES
from tallywatch.session import new_folder, shared_folder
from tallywatch.sinks.tables import replace_days
from tallywatch.sources.messages import parse_narrow


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hourly_job_reads_and_parses_once(spark, sf_dir):
    folder = new_folder(spark, "text")
    views.raw_messages(spark, sf_dir).write.text(folder)
    text = plan(hourly_counts(unify(parse_narrow(spark.read.text(folder)))))
    assert text.count("FileScan text") == 1
    assert text.count("from_json(") == 1
    assert text.count("Exchange") == 1
    assert "vict_age" not in text


def test_report_filters_reach_the_scan(spark, sf_dir):
    picked = in_range(for_place_and_type(views.scored(spark, sf_dir), "D1", "view"), views.AS_OF, "7d")
    text = plan(anomaly_metrics(picked))
    assert "EqualTo(event_type,view)" in text and "GreaterThan(ts,2024-01-24T00:00)" in text
    assert "event_id" not in text


def test_scoring_moves_no_rows(spark, planted):
    folder = new_folder(spark, "counts")
    planted.write.parquet(folder)
    counts = spark.read.parquet(folder)
    text = plan(score_counts(counts, train(counts, trees=3).model))
    assert "Exchange" not in text and "Join" not in text


def test_training_sample_is_cut_before_its_shuffle(spark, planted):
    text = plan(draw_samples(planted, 10**9, 100, 256, 42).groupBy("tree_id").count())
    assert text.count("Exchange hashpartitioning") == 1
    below = text[text.index("Exchange hashpartitioning"):]
    assert text.count("md5(") == 2 and "Generate explode(filter(" in below  # only chosen trees repeat a row


@pytest.mark.parametrize("name", ["time_grid_fill", "feature_alignment", "location_lookup", "scaler_fit"])
def test_no_pairs_of_everything(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_grid_sums_before_joining(spark, sf_dir):
    text = plan(time_grid(views.scored(spark, sf_dir), views.AS_OF))
    assert "partial_sum(" in text and text.count("FileScan") == 1 and "Join" not in text


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "a") != new_folder(spark, "a")


def test_only_a_local_session_has_a_folder_of_its_own():
    def session(master):
        unset = SimpleNamespace(get=lambda *_: None)
        context = SimpleNamespace(master=master, applicationId=f"app-{master}", getConf=lambda: unset)
        return SimpleNamespace(conf=unset, sparkContext=context)

    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))


def test_days_prune_the_tables_of_the_streams(spark, tmp_path):
    frame = spark.range(5).select(F.timestamp_seconds(F.col("id") * 86400).alias("window_start"), F.col("id").alias("incident_count"))
    replace_days(frame.withColumn("day", day_of(F.col("window_start"))), str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    since = days_of(table, date(1970, 1, 4))
    assert "PartitionFilters: [isnotnull(day" in since._jdf.queryExecution().executedPlan().toString()
    assert since.count() == 2
    recent = table.filter(on_report_days(F.col("day"), datetime(1970, 1, 4, 12), "24h"))
    assert recent.count() == 3 and "day" in recent._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]


def test_only_places_and_types_are_joined_when_scaling(spark, planted):
    folder = new_folder(spark, "counts")
    planted.write.parquet(folder)
    counts = spark.read.parquet(folder)
    scaler = fit_scaler(counts)
    stored = new_folder(spark, "scaler")
    scaler.write.parquet(stored)
    text = plan(scaled_features(counts, spark.read.parquet(stored), "window_start"))
    # The count is scaled by two scalars: its rows are in no join, and its feature is filtered out of the joined scaler.
    assert text.count("Join") == 1 and "NOT (feature" in text and text.count("Subquery") >= 2
