"""Writes that count once, versions under concurrent trainers, supervision."""

import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tallywatch.plans.training import claim_version, load_latest, registered, save_model, train
from tallywatch.session import new_folder
from tallywatch.sinks import commits
from tallywatch.sinks.commits import (
    append_once, commit, committed, compact, create_file, read_committed, write_rows,
)
from tallywatch.streaming import supervision
from tallywatch.streaming.supervision import QueryFailed, supervise


def test_one_of_many_attempts_creates_a_file(spark, tmp_path):
    (tmp_path / "f").mkdir()
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: create_file(spark, f"{tmp_path}/f/one", f"attempt {i}"), range(24)))
    assert won.count(True) == 1
    assert (tmp_path / "f" / "one").read_text() == f"attempt {won.index(True)}"
    assert [p.name for p in (tmp_path / "f").iterdir() if not p.name.endswith(".crc")] == ["one"]


def test_a_batch_counts_once(spark, rows, tmp_path):
    path, frame = str(tmp_path / "t"), spark.range(5).withColumnRenamed("id", "n")
    assert read_committed(spark, path, "n long").count() == 0
    assert append_once(frame, path, "q-0") and not append_once(frame, path, "q-0")
    # A writer that dies before its commit leaves rows that nobody sees, and the batch can still be written.
    write_rows({"data": frame}, path, "q-1")
    assert read_committed(spark, path, "n long").count() == 5
    assert append_once(frame, path, "q-1")
    # Of two writers that both got as far as the commit one wins.
    a, b = (write_rows({"data": frame}, path, "q-2") for _ in range(2))
    assert [commit(spark, path, "q-2", f) for f in (a, b)] == [True, False]
    assert committed(spark, path)["q-2"] == a
    assert rows(read_committed(spark, path, "n long")) == sorted([(i,) for i in range(5)] * 3)


def test_partitioned_batches(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "n long, day string")
    for number in range(2):
        append_once(frame, path, f"q-{number}", "parquet", "day")
    table = read_committed(spark, path, "n long, day string")
    assert rows(table.filter("day = 'a'"), "n", "day") == [(1, "a"), (1, "a")]
    plan = table.filter("day = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_an_append_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    path, frame = str(tmp_path / "t"), spark.range(3)

    def lost(*_):
        raise ConnectionError("lost")

    with monkeypatch.context() as broken, pytest.raises(ConnectionError):
        broken.setattr(commits, "commit", lost)
        append_once(frame, path, "q-0")
    assert committed(spark, path) == {}
    assert append_once(frame, path, "q-0") and read_committed(spark, path, "id long").count() == 3


def test_trainers_at_the_same_time_get_versions_of_their_own(spark, planted, tmp_path):
    run, root = train(planted, trees=3), str(tmp_path / "models")

    def save(i):
        return save_model(spark, SimpleNamespace(**{**vars(run), "run_id": f"r{i}"}), root)

    with ThreadPoolExecutor(4) as pool:
        paths = list(pool.map(save, range(20)))
    known = registered(spark, root, "hourly-anomalies").orderBy("version").collect()
    assert [r["version"] for r in known] == list(range(1, 21))
    assert sorted(r["path"] for r in known) == sorted(paths)
    latest = load_latest(spark, root)
    assert latest.forest.nodes.equals(run.model.forest.nodes)


def test_a_trainer_that_dies_leaves_a_gap(spark, planted, tmp_path):
    root = str(tmp_path / "models")
    assert claim_version(spark, root, "hourly-anomalies", "nowhere") == 1
    path = save_model(spark, train(planted, trees=3), root)
    assert [tuple(r) for r in registered(spark, root, "hourly-anomalies").collect()] == [("hourly-anomalies", 2, path)]
    save_model(spark, train(planted, trees=3), root, name="other")
    assert registered(spark, root, "other").first()["version"] == 1


class Scripted:
    """A query that ends after some looks at it, with or without a problem."""

    def __init__(self, looks, problem=None):
        self.looks, self.problem, self.stopped = looks, problem, False
        self.status = {"isTriggerActive": False}

    @property
    def isActive(self):
        self.looks -= 1
        return self.looks > 0 and not self.stopped

    def exception(self):
        return self.problem

    def stop(self):
        self.stopped = True


def test_a_query_that_fails_is_started_again():
    script = [Scripted(2, ValueError("a")), Scripted(2, ValueError("b")), Scripted(3)]
    outcome = supervise({"x": lambda: script.pop(0), "y": lambda: Scripted(20)}, budget=2, every=0.001)
    assert outcome.restarts == {"x": 2, "y": 0} and outcome.problems == {"x": ["a", "b"]}


def test_beyond_its_budget_the_others_are_stopped_and_it_is_named():
    other = Scripted(10**6)
    with pytest.raises(QueryFailed, match="x failed: again") as caught:
        supervise({"y": lambda: other, "x": lambda: Scripted(1, ValueError("again"))}, budget=2, every=0.001)
    assert caught.value.name == "x" and other.stopped


def test_a_query_that_does_not_start_is_named():
    def never():
        raise OSError("no checkpoint")

    other = Scripted(10**6)
    with pytest.raises(QueryFailed, match="x failed: no checkpoint"):
        supervise({"y": lambda: other, "x": never}, budget=1, every=0.001)
    assert other.stopped


def test_old_failures_do_not_count(monkeypatch):
    times = iter(range(0, 10**6, 100))
    monkeypatch.setattr(supervision.time, "monotonic", lambda: next(times))
    script = [Scripted(1, ValueError("x")) for _ in range(6)] + [Scripted(1)]
    assert supervise({"x": lambda: script.pop(0)}, budget=1, within=50, every=0).restarts == {"x": 6}


def test_a_real_query_is_stopped_between_batches(spark):
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    seen = []
    folder = new_folder(spark, "ticks")
    running = ticks.writeStream.foreachBatch(lambda frame, n: (time.sleep(0.3), seen.append(n))).option(
        "checkpointLocation", folder).trigger(processingTime="1 second").start()
    while not seen:
        time.sleep(0.05)
    supervision.stop_after_batch(running, 20)
    assert not running.isActive and running.exception() is None


SCHEMA = "n long, text string, day string"


def table_of(spark, path, batches, size=400):
    for number in range(batches):
        frame = spark.range(size * number, size * (number + 1)).select(
            F.col("id").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("text"),
            F.when(F.col("id") % 3 > 0, F.concat(F.lit("d/"), (F.col("id") % 3).cast("string"))).alias("day"))
        append_once(frame, path, f"q-{number}", "parquet", "day")
    return read_committed(spark, path, SCHEMA)


def test_compaction_keeps_all_rows_in_few_files(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    table = table_of(spark, path, 6)
    before, n_files = rows(table), len(table.inputFiles())
    size = sum(r[0] for r in table.select("_metadata.file_size", "_metadata.file_path").distinct().collect())
    limit = size // 8
    assert compact(spark, path, SCHEMA, "day", file_bytes=limit)
    after = read_committed(spark, path, SCHEMA)
    assert rows(after) == before
    per_day = after.select("day", "_metadata.file_path", "_metadata.file_size").distinct().groupBy("day").agg(
        F.count("*").alias("n"), F.sum("file_size").alias("size")).collect()
    assert len(per_day) == 3 and all(r["n"] <= size / 3 / limit + 2 for r in per_day)
    assert len(after.inputFiles()) < n_files
    # What has been replaced still counts as written, and its folders stay until somebody removes them.
    assert not append_once(spark.range(1).selectExpr("id AS n", "'x' AS text", "'y' AS day"), path, "q-3", "parquet", "day")
    assert rows(table) == before
    assert commits.remove_replaced(spark, path) == 6 and commits.remove_replaced(spark, path) == 0
    assert rows(read_committed(spark, path, SCHEMA)) == before


def test_batches_during_a_compaction_stay(spark, rows, tmp_path, monkeypatch):
    path, real = str(tmp_path / "t"), commits.write_rows
    table_of(spark, path, 2)
    late = spark.createDataFrame([(-1, "late", None)], SCHEMA)

    def slow(*given):
        folder = real(*given)
        monkeypatch.setattr(commits, "write_rows", real)
        append_once(late, path, "late", "parquet", "day")
        return folder

    monkeypatch.setattr(commits, "write_rows", slow)
    assert compact(spark, path, SCHEMA, "day")
    assert set(committed(spark, path)) == {"compacted-000000000", "late"}
    assert read_committed(spark, path, SCHEMA).count() == 801
    assert compact(spark, path, SCHEMA, "day") and set(committed(spark, path)) == {"compacted-000000001"}
    assert not compact(spark, path, SCHEMA, "day")
    assert read_committed(spark, path, SCHEMA).count() == 801


def test_one_of_two_compactions_counts(spark, tmp_path, monkeypatch):
    path, real = str(tmp_path / "t"), commits.write_rows
    table_of(spark, path, 3)

    def overtaken(*given):
        folder = real(*given)
        monkeypatch.setattr(commits, "write_rows", real)
        assert compact(spark, path, SCHEMA, "day")
        return folder

    monkeypatch.setattr(commits, "write_rows", overtaken)
    assert not compact(spark, path, SCHEMA, "day")
    assert read_committed(spark, path, SCHEMA).count() == 1200


def test_compaction_without_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for number in range(3):
        append_once(spark.range(10), path, f"q-{number}")
    assert compact(spark, path, "id long") and len(read_committed(spark, path, "id long").inputFiles()) == 1
    assert read_committed(spark, path, "id long").count() == 30


def test_two_tables_take_a_batch_together(spark, tmp_path):
    path = str(tmp_path / "t")
    both = {"a": spark.range(2), "b": spark.range(3)}
    write_rows(both, path, "q-0")
    assert [read_committed(spark, path, "id long", table=t).count() for t in "ab"] == [0, 0]
    assert append_once(both, path, "q-0") and not append_once(both, path, "q-0")
    assert [read_committed(spark, path, "id long", table=t).count() for t in "ab"] == [2, 3]
