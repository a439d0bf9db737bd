from datetime import date

import pytest
from pyspark.sql import functions as F

from tallywatch.functions.times import day_of
from tallywatch.operators import day_states
from tallywatch.operators.features import fit_scaler
from tallywatch.plans.training import train, train_by_days
from tallywatch.sinks.tables import replace_days
from tallywatch.sources.tables import read_table


@pytest.fixture(scope="module")
def hourly(spark, planted, tmp_path_factory):
    """The planted rows as a table partitioned by day; some counts are missing."""
    folder = str(tmp_path_factory.mktemp("hourly") / "table")
    rows = planted.withColumn("incident_count", F.when(F.col("incident_count") != 7, F.col("incident_count")))
    replace_days(rows.withColumn("day", day_of(F.col("window_start"))), folder)
    return read_table(spark, folder)


def all_days(hourly):
    return sorted(r["day"] for r in hourly.select("day").distinct().collect())


def same(spark, rows, run, other):
    assert run.model.forest.nodes.equals(other.model.forest.nodes)
    assert (run.model.offset, run.n_rows, run.n_anomalies) == (other.model.offset, other.n_rows, other.n_anomalies)
    columns = ["feature", *(F.round(c, 9) for c in ("mean", "std", "absent"))]
    assert rows(run.scaler, *columns) == rows(other.scaler, *columns)


def test_days_put_together_give_the_training_over_all_rows(spark, rows, hourly, tmp_path):
    state, days = str(tmp_path / "state"), all_days(hourly)
    for some in (days[3:9], days[:3], days[9:], days[4:6]):  # in any order, some of them again
        day_states.add_days(spark, hourly, state, some, trees=20)
    whole = train(hourly, trees=20)
    same(spark, rows, train_by_days(spark, state, trees=20), whole)
    since = days[-5]
    late = train(hourly.filter(F.col("day") >= F.lit(since)), trees=20)
    same(spark, rows, train_by_days(spark, state, trees=20, since=since), late)
    assert rows(day_states.scaler_of(day_states.combinations(spark, state)).select("feature")) == rows(
        fit_scaler(hourly).select("feature"))


def test_a_day_is_added_from_its_own_files(spark, hourly):
    day = all_days(hourly)[2]
    plan = day_states.of_days(hourly, [day])
    for frame in (day_states.day_combinations(plan), day_states.day_draws(plan, 5, 8, 1)):
        text = frame._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in text.splitlines() if "FileScan" in line]
        assert scans and all(f"PartitionFilters: [isnotnull(day#" in s and str(day) in s for s in scans)


def test_draws_are_bounded_by_trees_whatever_the_day_holds(spark, hourly, tmp_path):
    state = str(tmp_path / "state")
    day_states.add_days(spark, hourly, state, all_days(hourly)[:2], trees=10, max_samples=6)
    held = day_states.draws(spark, state).groupBy("day", "tree_id").count().collect()
    assert len(held) == 20 and {r["count"] for r in held} == {6}


def test_a_bound_that_was_too_low_is_raised(spark, rows, hourly, tmp_path):
    a, b, days = str(tmp_path / "a"), str(tmp_path / "b"), all_days(hourly)[:2]
    day_states.add_days(spark, hourly, a, days, trees=10, max_samples=6, oversampling=1)
    day_states.add_days(spark, hourly, b, days, trees=10, max_samples=6, oversampling=1000)
    assert rows(day_states.draws(spark, a)) == rows(day_states.draws(spark, b))


def test_days_without_rows(spark, hourly, tmp_path):
    state = str(tmp_path / "state")
    day_states.add_days(spark, hourly, state, all_days(hourly)[:1], trees=3)
    before = day_states.combinations(spark, state).count()
    day_states.add_days(spark, hourly, state, [date(1999, 1, 1)], trees=3)
    assert day_states.combinations(spark, state).count() == before
    with pytest.raises(ValueError, match="no rows"):
        train_by_days(spark, state, trees=3, since=date(2099, 1, 1))


def test_moments_are_exact(spark):
    rows = [("A", "x", 3_000_000_000, 5), ("A", "y", 1, 7), (None, "x", 0, 2)]
    scaler = {r["feature"]: r for r in day_states.scaler_of(
        spark.createDataFrame(rows, "location_name string, crime_type string, incident_count long, n long")).collect()}
    count = scaler["incident_count"]
    assert count["mean"] == (15_000_000_000 + 7) / 14
    assert abs(count["std"] ** 2 - (14 * (5 * 9 * 10**18 + 7) - (15_000_000_007) ** 2) / 14**2) < 1e4
    assert scaler["location_A"]["mean"] == 12 / 14
