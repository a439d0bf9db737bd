"""Edges of the reports."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallywatch.functions.times import previous_month_key
from tallywatch.operators import reports as ops
from tallywatch.operators.grid import time_grid
from tallywatch.operators.scoring import invalid_requests, valid_requests
from tallywatch.schema import SCORE_REQUEST, SCORED
from tallywatch.sources.tables import read_score_requests

AS_OF = datetime(2024, 3, 1, 10, 30)


@pytest.fixture()
def frame(spark):
    def build(*rows):
        return spark.createDataFrame([(p, t, AS_OF - timedelta(hours=h), n, s, True) for p, t, h, n, s in rows], SCORED)

    return build


def test_ranges_are_strict(frame):
    scored = frame(*[("p", "t", h, 1, 0.0) for h in (23, 24, 71, 72, 167, 168)])
    assert [ops.in_range(scored, AS_OF, r).count() for r in ("24h", "3d", "7d", "anything")] == [1, 3, 5, 5]


def test_flag_is_strict_and_replaces_the_one_that_came(frame):
    scored = frame(("p", "t", 1, 1, 0.2), ("p", "t", 2, 1, 0.25), ("p", "t", 3, 1, None))
    assert [r["is_anomaly"] for r in ops.flagged(scored).orderBy("anomaly_score").collect()] == [False, False, True]
    assert [r["anomaly_score"] for r in ops.anomalies(scored).collect()] == [0.25]


def test_metrics_of_nothing(frame):
    nothing = ops.anomaly_metrics(frame(("p", "t", 1, 5, 0.9)).filter(F.lit(False))).first()
    assert (nothing["total_incidents"], nothing["anomalous_incidents"], nothing["anomaly_percentage"]) == (0, 0, 0.0)
    zero = ops.anomaly_metrics(frame(("p", "t", 1, 0, 0.9))).first()
    assert (zero["total_incidents"], zero["anomaly_percentage"]) == (0, 0.0)


def test_metrics(frame):
    found = ops.anomaly_metrics(frame(("p", "t", 1, 2, 0.9), ("p", "t", 2, 4, 0.1)), 0.5).first()
    assert tuple(found) == (6, 2, 33.33, 0.5)


def test_histogram_edges(frame):
    scored = frame(("p", "t", 1, 1, 0.0), ("p", "t", 1, 1, 1.0), ("p", "t", 1, 1, 0.05), ("p", "t", 1, 1, None))
    assert {r["bin"]: r["n"] for r in ops.score_histogram(scored).collect()} == {0: 1, 1: 1, 19: 1}


def test_recent_are_the_latest_five(frame):
    scored = frame(*[("p", "t", h, h, 0.9) for h in range(1, 9)], ("p", "t", 0, 99, 0.1))
    found = ops.recent_anomalies(scored).collect()
    assert [r["incident_count"] for r in found] == [1, 2, 3, 4, 5]
    assert found[0]["timestamp"] == "2024-03-01 09:30"


def test_distribution_leaves_out_missing_types(frame):
    scored = frame(("p", "t", 1, 2, 0.1), ("p", "t", 900, 3, 0.1), ("p", None, 1, 7, 0.1), ("q", "t", 1, 9, 0.1))
    assert [tuple(r) for r in ops.type_distribution(scored, "p").collect()] == [("t", 5)]


def test_grid_is_complete_for_any_as_of(frame):
    scored = frame(("p", "t", 1, 2, 0.1), ("p", "t", 2, 3, 0.1), ("q", "u", 7, 5, 0.1), ("q", "u", 500, 8, 0.1))
    grid = time_grid(scored, AS_OF)
    assert grid.count() == 2 * 28  # p was never seen with u, nor q with t
    assert "SinglePartition" not in grid._jdf.queryExecution().executedPlan().toString()
    assert grid.agg(F.min("timestamp"), F.max("timestamp")).first() == (
        AS_OF - timedelta(days=7), AS_OF - timedelta(hours=6)
    )
    filled = {(r["location_name"], r["crime_type"], r["timestamp"]): r["incident_count"]
              for r in grid.filter("incident_count > 0").collect()}
    assert filled == {
        ("p", "t", AS_OF - timedelta(hours=6)): 5, ("q", "u", AS_OF - timedelta(hours=12)): 5,
    }


def test_previous_month_key():
    assert previous_month_key(datetime(2024, 1, 31)) == "2023-12"
    assert previous_month_key(datetime(2024, 3, 31)) == "2024-02"


def test_requests_split(spark):
    requests = spark.createDataFrame(
        [(1, "p", "t", 1, None), (2, None, "t", 1, None), (3, "p", None, None, {"a": 1.0}),
         (4, "p", "t", 1, {"a": None}), (5, "p", "t", 1, {})],
        SCORE_REQUEST,
    )
    assert sorted(r["request_id"] for r in valid_requests(requests).collect()) == [1, 5]
    assert {r["request_id"]: r["invalid_field"] for r in invalid_requests(requests).collect()} == {
        2: "location_name", 3: "crime_type", 4: "additional_features"
    }


def test_requests_read_leniently(spark, tmp_path):
    (tmp_path / "requests.json").write_text(
        '{"request_id": 1, "location_name": "p", "crime_type": 7, "incident_count": "12",'
        ' "additional_features": {"a": "1.5", "b": 2}}\n'
        '{"request_id": 2, "location_name": "p", "crime_type": "t", "incident_count": 12.7}\n'
        '{"request_id": 3, "location_name": "p", "crime_type": "t", "incident_count": "many"}\n'
        '{"request_id": 4, "location_name": "p", "crime_type": "t", "incident_count": 1,'
        ' "additional_features": {"a": "x"}}\n'
    )
    requests = read_score_requests(spark, str(tmp_path))
    assert requests.schema == SCORE_REQUEST
    good = {r["request_id"]: r for r in valid_requests(requests).collect()}
    assert set(good) == {1, 2}
    assert (good[1]["crime_type"], good[1]["incident_count"], good[2]["incident_count"]) == ("7", 12, 12)
    assert good[1]["additional_features"] == {"a": 1.5, "b": 2.0}
    assert {r["request_id"]: r["invalid_field"] for r in invalid_requests(requests).collect()} == {
        3: "incident_count", 4: "additional_features"
    }
