"""Properties of the forest: what it may not depend on, and what it must find."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.operators import forest as forest_module
from tallywatch.operators.forest import draw_samples, fit_forest, mean_path, tree_grower
from tallywatch.operators.scoring import score_counts, score_requests
from tallywatch.plans.training import load_latest, load_model, run_log, save_model, save_run, train, train_metrics
from tallywatch.schema import SCORE_REQUEST
from tallywatch.session import new_folder

COLUMNS = ("incident_count", "location_name", "crime_type")


@pytest.fixture(scope="module")
def run(planted):
    return train(planted)


def plain_score(nodes, per_tree, features):
    """Score of one row by walking every tree node by node."""
    lengths = []
    for _, tree in nodes.groupby("tree_id"):
        tree = tree.set_index("node_id")
        node = tree.loc[1]
        while isinstance(node["feature"], str):
            left = features.get(node["feature"], 0.0) <= node["threshold"]
            node = tree.loc[int(node["left_id"] if left else node["right_id"])]
        lengths.append(node["depth"] + mean_path(node["n_rows"]))
    return -(2.0 ** (-np.mean(lengths) / mean_path(per_tree)))


def test_mean_path():
    assert (mean_path(0), mean_path(1), mean_path(2)) == (0, 0, 1)
    assert mean_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_forest_does_not_depend_on_partitioning(planted):
    one = fit_forest(planted.coalesce(1), trees=7).nodes
    many = fit_forest(planted.repartition(13, "crime_type"), trees=7).nodes
    assert one.equals(many)


def test_a_bound_too_low_is_raised_until_trees_are_whole(planted, monkeypatch):
    whole = fit_forest(planted, trees=5, max_samples=64).nodes
    monkeypatch.setattr(forest_module, "OVERSAMPLING", 1)
    assert fit_forest(planted, trees=5, max_samples=64).nodes.equals(whole)


def test_samples_are_exact_with_and_without_the_bound(planted):
    few = [draw_samples(planted, 1010, 5, 16, 42, oversampling=o).select("tree_id", "draw").collect() for o in (4, 1000)]
    assert sorted(few[0]) == sorted(few[1])
    assert len(few[0]) == 5 * 16


def test_tree_shape(planted):
    forest = fit_forest(planted, trees=20)
    nodes = forest.nodes
    assert forest.per_tree == 256
    assert nodes["depth"].max() <= math.ceil(math.log2(256))
    assert len(nodes) <= 20 * (2 * 256 - 1)
    leaves = nodes[nodes["feature"].isna()]
    assert (leaves.groupby("tree_id")["n_rows"].sum() == 256).all()


def test_trees_split_the_rows_drawn_for_them(planted):
    """Route every drawn row from the root by hand and count who passes which node."""
    drawn = draw_samples(planted, 1010, 6, 64, 42).toPandas()
    nodes = fit_forest(planted, trees=6, max_samples=64).nodes.set_index(["tree_id", "node_id"])
    passed = Counter()
    for row in drawn.itertuples():
        own = {"incident_count": row.incident_count, f"location_{row.location_name}": 1, f"crime_{row.crime_type}": 1}
        at = 1
        while True:
            passed[row.tree_id, at] += 1
            node = nodes.loc[(row.tree_id, at)]
            if not isinstance(node["feature"], str):
                break
            at = int(node["left_id"] if own.get(node["feature"], 0) <= node["threshold"] else node["right_id"])
    assert passed == Counter(nodes["n_rows"].to_dict())


def test_splits_choose_evenly_among_varying_features(planted):
    rows = draw_samples(planted, 1010, 1, 256, 42).toPandas()
    grow, chosen = tree_grower(256, 42), Counter()
    for tree in range(400):
        grown = grow(rows.assign(tree_id=tree))
        chosen[grown.loc[grown["node_id"] == 1, "feature"].iloc[0]] += 1
    assert len(chosen) == 10
    assert all(20 <= n <= 65 for n in chosen.values())


def test_planted_outliers_rank_first(planted, run):
    scored = score_counts(planted, run.model)
    worst = scored.orderBy("raw_score").limit(10).collect()
    assert all(r["incident_count"] >= 200 for r in worst)


def test_labels_follow_the_decision(planted, run):
    scored = score_counts(planted, run.model).toPandas()
    assert ((scored["label"] == -1) == (scored["decision"] < 0)).all()
    assert ((scored["label"] == -1) == scored["is_anomaly"]).all()
    assert (scored["anomaly_score"] == (scored["label"] == -1).astype(float)).all()
    assert scored["raw_score"].between(-1, 0, inclusive="left").all()
    assert run.model.offset == pytest.approx(np.quantile(scored["raw_score"], 0.05), abs=1e-15)
    assert run.n_rows == len(scored) and run.n_anomalies == (scored["label"] == -1).sum()
    assert 0 < run.n_anomalies <= math.ceil(0.05 * len(scored))


def test_scores_equal_a_plain_walk(spark, planted, run):
    cases = [(9, "P1", "T3"), (205, "P0", "T0"), (0, "P2", None), (7, None, "T1"), (12, "elsewhere", "T4"), (None, "P3", "T2")]
    frame = spark.createDataFrame(cases, "incident_count long, location_name string, crime_type string")
    found = frame.withColumn("s", run.model.forest.raw_score(*map(F.col, COLUMNS))).collect()
    for row in found:
        features = {"incident_count": float(row["incident_count"] or 0)}
        features |= {f"location_{row['location_name']}": 1.0, f"crime_{row['crime_type']}": 1.0}
        assert row["s"] == pytest.approx(plain_score(run.model.forest.nodes, 256, features), abs=1e-12)


def test_scores_do_not_depend_on_what_a_task_remembers(spark, planted, run, rows, monkeypatch):
    usual = rows(score_counts(planted, run.model))
    monkeypatch.setattr(forest_module, "REMEMBERED", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        assert rows(score_counts(planted, run.model)) == usual
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_request_features_replace_the_model_s(spark, run):
    cases = [
        (1, "P1", "T3", 9, None),
        (2, "P1", "T3", 9, {"note": 5.0}),
        (3, "P1", "T3", 9, {"incident_count": 500.0}),
        (4, "P1", "T3", 9, {"location_P1": 0.0, "location_P2": 1.0}),
        (5, "P1", "T3", 9, {"crime_T3": 0.5, "crime_unseen": 1.0}),
    ]
    answers = {r["request_id"]: r for r in score_requests(spark.createDataFrame(cases, SCORE_REQUEST), run.model).collect()}
    assert answers[1]["raw_score"] == answers[2]["raw_score"]
    for number, place, kind, count, extras in cases:
        features = {"incident_count": float(count), f"location_{place}": 1.0, f"crime_{kind}": 1.0, **(extras or {})}
        want = plain_score(run.model.forest.nodes, 256, features)
        assert answers[number]["raw_score"] == pytest.approx(want, abs=1e-12)
    assert answers[3]["is_anomaly"] and answers[3]["anomaly_score"] == 1.0


def test_tiny_tables(spark, planted):
    for n in (1, 2, 3):
        some = planted.orderBy("window_start").limit(n)
        outcome = train(some, trees=3)
        assert outcome.n_rows == n
        assert score_counts(some, outcome.model).count() == n


def test_hours_far_off_do_not_matter(planted):
    some = planted.limit(50).withColumn("window_start", F.timestamp_seconds(F.unix_seconds("window_start") + 40_000_000_000))
    assert train(some, trees=3).n_rows == 50


def test_empty_table_is_refused(planted):
    with pytest.raises(ValueError, match="no rows"):
        train(planted.filter(F.lit(False)))


def test_save_load_and_latest(spark, planted, run, rows):
    root = new_folder(spark, "models")
    first = save_model(spark, run, root)
    second = save_model(spark, train(planted, trees=3), root)
    assert first != second
    assert load_latest(spark, root, "none").forest.nodes["tree_id"].nunique() == 3
    assert spark.read.parquet(f"{root}/registry").count() == 2
    loaded = load_model(spark, first)
    assert rows(score_counts(planted, loaded)) == rows(score_counts(planted, run.model))
    fallback = load_latest(spark, new_folder(spark, "empty"), first)
    assert fallback.offset == run.model.offset
    with pytest.raises(ValueError, match="no model"):
        load_latest(spark, new_folder(spark, "empty"))
    other = load_latest(spark, root, first, name="unregistered")
    assert other.offset == run.model.offset


def test_run_log_and_metrics(spark, run):
    folder = new_folder(spark, "runs")
    save_run(spark, run, folder)
    save_run(spark, run, folder)
    log = {(r["kind"], r["key"]): r["value"] for r in spark.read.parquet(folder).collect()}
    assert spark.read.parquet(folder).count() == 10
    assert log[("param", "n_estimators")] == "100" and log[("param", "contamination")] == "0.05"
    assert log[("metric", "n_anomalies")] == str(run.n_anomalies)
    metrics = train_metrics(spark, run).first()
    assert metrics["anomaly_ratio"] == run.n_anomalies / run.n_rows
    assert run_log(spark, run).count() == 5
