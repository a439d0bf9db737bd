"""One-hot columns, scaling and alignment."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.functions.scores import merged_features
from tallywatch.operators import features as ops

COUNTS = [(4, "A", "x"), (2, "B", "x"), (None, "A", None), (7, None, "y"), (2, "A", "y")]


@pytest.fixture()
def counts(spark):
    return spark.createDataFrame(COUNTS, "incident_count long, location_name string, crime_type string")


NAMES = ["location_A", "location_B", "crime_x", "crime_y"]
MATRIX = np.array(
    [[4, 1, 0, 1, 0], [2, 0, 1, 1, 0], [0, 1, 0, 0, 0], [7, 0, 0, 0, 1], [2, 1, 0, 0, 1]], dtype=float
)


def as_matrix(frame, names, rows=len(COUNTS), absent=None):
    """Rows of a sparse frame (id, feature, value) as dense ones."""
    matrix = np.tile([0.0 if absent is None else absent[n] for n in names], (rows, 1))
    for r in frame.collect():
        matrix[r["id"], names.index(r["feature"])] = r["value"]
    return matrix


def numbered(frame):
    return frame.coalesce(1).withColumn("id", F.monotonically_increasing_id())


ALL = ["incident_count", *NAMES]


def test_one_hot(counts):
    assert (as_matrix(ops.sparse_features(numbered(counts), "id"), ALL) == MATRIX).all()


def test_scaler_equals_dense_statistics(counts):
    fitted = {r["feature"]: (r["mean"], r["std"]) for r in ops.fit_scaler(counts).collect()}
    for i, name in enumerate(["incident_count", *NAMES]):
        assert fitted[name] == pytest.approx((MATRIX[:, i].mean(), MATRIX[:, i].std()))


def test_constant_feature_scales_to_zero(spark):
    same = spark.createDataFrame([(3, "A", "x")] * 4, "incident_count long, location_name string, crime_type string")
    values = ops.scaled_features(numbered(same), ops.fit_scaler(same), "id").collect()
    assert len(values) == 12 and all(r["value"] == 0 for r in values)


def test_scaled_values_and_those_of_absent_features(counts):
    scaler = ops.fit_scaler(counts)
    absent = {r["feature"]: r["absent"] for r in scaler.collect()}
    want = (MATRIX - MATRIX.mean(axis=0)) / MATRIX.std(axis=0)
    assert np.allclose(as_matrix(ops.scaled_features(numbered(counts), scaler, "id"), ALL, absent=absent), want)


def test_unseen_values_have_no_scaled_feature(spark, counts):
    new = numbered(spark.createDataFrame([(1, "Z", "x")], counts.schema))
    found = ops.scaled_features(new, ops.fit_scaler(counts), "id").collect()
    assert sorted(r["feature"] for r in found) == ["crime_x", "incident_count"]


def test_names_are_data(spark):
    odd = [(1, "OFF. `A` & B", "theft"), (2, "location_x", "THEFT"), (3, "", "crime_")]
    frame = spark.createDataFrame(odd, "incident_count long, location_name string, crime_type string")
    for found in (ops.sparse_features(frame), ops.scaled_features(frame, ops.fit_scaler(frame))):
        names = [r["feature"] for r in found.collect()]
        assert len(names) == 9 and names.count("incident_count") == 3 and len(set(names)) == 7


def test_many_places(spark):
    frame = spark.range(1500).select(
        F.lit(1).alias("incident_count"), F.concat(F.lit("P"), "id").alias("location_name"), F.lit("t").alias("crime_type"))
    assert ops.scaled_features(frame, ops.fit_scaler(frame)).select("feature").distinct().count() == 1502


def test_the_scaler_counts_its_rows_once(counts):
    text = ops.fit_scaler(counts)._jdf.queryExecution().executedPlan().toString()
    assert "count(1)" in text and "SinglePartition" not in text


def test_sparse_rows_sum_to_the_dense_matrix(counts):
    totals = {r["feature"]: r["t"] for r in ops.sparse_features(counts).groupBy("feature").agg(F.sum("value").alias("t")).collect()}
    assert totals == dict(zip(["incident_count", *NAMES], MATRIX.sum(axis=0)))


def test_alignment_of_unseen_values(spark, counts):
    requests = spark.createDataFrame(
        [(1, "A", "y"), (2, "Z", "x"), (3, None, "q")], "request_id long, location_name string, crime_type string"
    )
    found = ops.aligned(requests, ops.vocabulary(counts)).orderBy("request_id").collect()
    assert [(r["place_column"], r["type_column"]) for r in found] == [
        ("location_A", "crime_y"), (None, "crime_x"), (None, None)
    ]


def test_request_features_win(spark):
    frame = spark.range(1).select(
        merged_features(F.create_map(F.lit("a"), F.lit(1.0), F.lit("b"), F.lit(2.0)),
                        F.create_map(F.lit("b"), F.lit(9.0), F.lit("c"), F.lit(3.0))).alias("m"),
        merged_features(F.create_map(F.lit("a"), F.lit(1.0)), F.lit(None).cast("map<string,double>")).alias("n"),
    )
    row = frame.first()
    assert row["m"] == {"a": 1.0, "b": 9.0, "c": 3.0}
    assert row["n"] == {"a": 1.0}
