"""The exact quantile against numpy."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.operators.quantile import exact_quantile, quantile_of_counts, value_counts


def frame_of(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "score double")


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.999, 1.0])
@pytest.mark.parametrize("limits", [{}, {"buckets": 4, "few": 3}])
@pytest.mark.parametrize("kind", ["normal", "hot", "wide", "same"])
def test_equals_numpy(spark, q, limits, kind):
    chance = np.random.default_rng(7)
    values = {
        "normal": chance.normal(size=301),
        "hot": np.concatenate([np.full(150, -0.4), chance.normal(size=150)]),
        "wide": 10.0 ** chance.uniform(-9, 9, size=120),
        "same": np.full(9, 2.5),
    }[kind]
    with value_counts(frame_of(spark, values), "score") as counts:
        assert quantile_of_counts(counts, q, **limits) == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_nulls_do_not_count(spark):
    frame = spark.createDataFrame([(1.0,), (None,), (3.0,)], "score double")
    assert exact_quantile(frame, "score", 0.5) == 2.0


def test_nothing_to_rank(spark):
    assert exact_quantile(frame_of(spark, [1.0]).filter(F.lit(False)), "score", 0.5) is None


@pytest.mark.parametrize("odd", [[float("nan")], [float("inf")], [float("-inf")], [float("nan"), float("inf"), float("-inf")]])
def test_values_without_a_rank_are_set_aside(spark, odd):
    values = np.random.default_rng(3).normal(size=200)
    with value_counts(frame_of(spark, [*values, *odd]), "score") as counts:
        assert quantile_of_counts(counts, 0.3, buckets=4, few=3) == pytest.approx(np.quantile(values, 0.3), rel=1e-12)
        assert counts.count() == 200


def test_the_widest_range_of_doubles(spark):
    values = [-1.7e308, *range(50), 1.7e308]
    with value_counts(frame_of(spark, values), "score") as counts:
        assert quantile_of_counts(counts, 0.0, buckets=4, few=3) == -1.7e308
        with pytest.raises(ValueError, match="told apart"):
            quantile_of_counts(counts, 0.5, buckets=1, few=3)


def test_nothing_is_left_behind(spark):
    frame = frame_of(spark, [1.0, 2.0])
    exact_quantile(frame, "score", 0.5)
    with value_counts(frame, "score") as counts:
        (folder,) = {os.path.dirname(f.removeprefix("file://")) for f in counts.inputFiles()}
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
