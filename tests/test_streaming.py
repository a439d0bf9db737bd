"""Watermarks, late rows, restarts and scoring in streams."""

import json
import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.operators.aggregates import hourly_counts
from tallywatch.operators.normalize import unify
from tallywatch.operators.scoring import score_counts
from tallywatch.plans.training import train
from tallywatch.schema import HOURLY
from tallywatch.session import new_folder
from tallywatch.sinks.commits import compact, read_committed
from tallywatch.sources.messages import parse_narrow, stream_messages
from tallywatch.streaming import jobs

BASE = int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp())


def message(minute, **more):
    return json.dumps(
        {"source": "la", "timestamp": BASE + 60 * minute, "area_name": "a", "crm_cd_desc": "t", **more}
    )


def land(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def closed(spark, path):
    found = spark.read.parquet(path).select("window_start", "incident_count").collect()
    return sorted((r["window_start"].hour, r["incident_count"]) for r in found)


LATE_SCRIPT = [[5, 30], [70, 119], [125, 20], [185, 30], [10, 200]]


def dropped_rows(query):
    progress = [json.loads(p.json) for p in query.recentProgress]
    return sum(operator["numRowsDroppedByWatermark"] for p in progress for operator in p["stateOperators"])


def test_late_rows_over_five_batches_in_a_row(spark, tmp_path):
    """Rows are tested against the watermark of the batch before: the 00:30 row of the fourth batch counts,
    the 00:10 row of the fifth is dropped."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    for i, minutes in enumerate(LATE_SCRIPT):
        land(source, f"{i}.json", *[message(m) for m in minutes])
        os.utime(source / f"{i}.json", (BASE + i, BASE + i))
    messages = stream_messages(spark, "text", str(source), maxFilesPerTrigger="1")
    query = jobs.start_hourly(messages, out, str(tmp_path / "cp"), trigger=jobs.ONCE)
    query.awaitTermination()
    assert closed(spark, out) == [(0, 4), (1, 2)]
    assert dropped_rows(query) == 1


def test_late_rows_of_polls_that_wait_for_each_other(spark, tmp_path):
    """With time between the polls an empty batch brings the watermark up to date, and the 00:30 row of the
    fourth poll is late as well."""
    source, out, dropped = tmp_path / "in", str(tmp_path / "out"), 0
    for i, minutes in enumerate(LATE_SCRIPT):
        land(source, f"{i}.json", *[message(m) for m in minutes])
        messages = stream_messages(spark, "text", str(source))
        query = jobs.start_hourly(messages, out, str(tmp_path / "cp"), trigger=jobs.ONCE)
        query.awaitTermination()
        dropped += dropped_rows(query)
    assert closed(spark, out) == [(0, 3), (1, 2)]
    assert dropped == 2


def test_rows_late_by_less_than_an_hour_all_count(spark, tmp_path, rows):
    """Out of order by up to 50 minutes over seven batches: closed windows hold what a batch counts."""
    chance, source, out = random.Random(5), tmp_path / "in", str(tmp_path / "out")
    lines = [message(now - chance.randrange(50), area_name=chance.choice("aab")) for now in range(60, 700, 2)]
    for i in range(7):
        land(source, f"{i}.json", *lines[i * len(lines) // 7:(i + 1) * len(lines) // 7])
        os.utime(source / f"{i}.json", (BASE + i, BASE + i))
    messages = stream_messages(spark, "text", str(source), maxFilesPerTrigger="1")
    query = jobs.start_hourly(messages, out, str(tmp_path / "cp"), trigger=jobs.ONCE)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 7
    assert dropped_rows(query) == 0
    unified = unify(parse_narrow(spark.read.text(str(source))))
    watermark = unified.agg(F.max("event_time")).first()[0] - timedelta(hours=1)
    batch = hourly_counts(unified).filter(F.col("window_end") <= F.lit(watermark))
    assert rows(spark.read.parquet(out), *batch.columns) == rows(batch)


def test_resume_neither_loses_nor_repeats(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        messages = stream_messages(spark, "text", str(source))
        jobs.start_hourly(messages, out, checkpoint, trigger=jobs.ONCE).awaitTermination()

    land(source, "1.json", *[message(m) for m in (5, 30, 70)])
    run()
    run()
    land(source, "2.json", *[message(m) for m in (80, 200)])
    run()
    assert closed(spark, out) == [(0, 2), (1, 2)]


def test_state_partitions_are_fixed_by_the_first_start(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), tmp_path / "cp"
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    for i, partitions in enumerate((3, 2)):
        land(source, f"{i}.json", message(5 + 300 * i))
        messages = stream_messages(spark, "text", str(source))
        jobs.start_hourly(messages, out, str(checkpoint), partitions, trigger=jobs.ONCE).awaitTermination()
    assert len([p for p in (checkpoint / "state" / "0").iterdir() if p.name.isdigit()]) == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual
    assert closed(spark, out) == [(0, 1)]


def test_rows_without_event_time_or_source_do_not_count(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    land(source, "1.json", message(5), message(0, timestamp=None), message(6, source="other"), "junk", message(500))
    messages = stream_messages(spark, "text", str(source))
    jobs.start_hourly(messages, out, str(tmp_path / "cp"), trigger=jobs.ONCE).awaitTermination()
    assert closed(spark, out) == [(0, 1)]


def test_raw_table_is_partitioned_by_source_and_day(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    land(source, "1.json", message(5), message(6, source="nyc", ofns_desc="x", boro_nm="Q"), message(7, source="z"))
    messages = stream_messages(spark, "text", str(source))
    query = jobs.start_raw(messages, out, str(tmp_path / "cp"), trigger=jobs.ONCE)
    query.awaitTermination()
    seen = query.lastProgress.observedMetrics["ingest"]
    assert seen.asDict() == {"total": 2, "uk_police": 0, "chicago": 0, "nyc": 1, "la": 1}
    raw = spark.read.parquet(out)
    assert len(raw.columns) == 67
    assert {str(r["day"]) for r in raw.collect()} == {"2024-01-01"}
    assert sorted((r["source"], r["crime_type"]) for r in raw.collect()) == [("la", "t"), ("nyc", "x")]
    only = raw.filter(F.col("source") == "la")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in only


def test_stream_scores_equal_batch_scores(spark, planted, rows):
    folder, out = new_folder(spark, "counts"), new_folder(spark, "scores")
    planted.write.parquet(folder)
    model = train(spark.read.parquet(folder)).model
    counts = spark.readStream.schema(HOURLY).parquet(folder)
    jobs.start_scores(counts, model, out, new_folder(spark, "cp"), trigger=jobs.ONCE).awaitTermination()
    batch = score_counts(spark.read.parquet(folder), model)
    assert rows(spark.read.parquet(out), *batch.columns) == rows(batch)


def test_waiting_notices_a_failure_of_any_query(spark, tmp_path):
    land(tmp_path / "in", "1.json", message(5))
    spark.streams.resetTerminated()
    broken = stream_messages(spark, "text", str(tmp_path / "in")).select(
        F.raise_error(F.col("value")).cast("string").alias("value")
    )
    fine = spark.readStream.format("rate").load()
    running = fine.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp1")).start()
    try:
        jobs.start_messages(broken, str(tmp_path / "out"), str(tmp_path / "cp2"))
        with pytest.raises(StreamingQueryException):
            jobs.await_all(spark)
    finally:
        running.stop()
        spark.streams.resetTerminated()


def test_repeats_are_dropped_while_they_are_remembered(spark, tmp_path):
    """One poll per file: a record that comes again within the time remembered is known, also after a restart; records
    without an id are known by their text; unusable messages are left out."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    again = message(0, dr_no="1")
    polls = [
        [again, again, message(0), message(0), '{"source":"la"}', "no json", message(0, source="mars", dr_no="1")],
        [message(60, dr_no="1"), message(60, dr_no="2"), message(0), message(1, source="nyc", cmplnt_num="1")],
        [message(500, dr_no="3")],
        [message(600, dr_no="1"), message(600, dr_no="2")],
    ]
    for i, lines in enumerate(polls):
        land(source, f"{i}.json", *lines)
        messages = stream_messages(spark, "text", str(source))
        jobs.start_unique(messages, out, str(tmp_path / "cp"), "2 hours", trigger=jobs.ONCE).awaitTermination()
    kept = sorted(r[0] for r in spark.read.parquet(out).collect())
    first = [again, message(0), message(60, dr_no="2"), message(1, source="nyc", cmplnt_num="1")]
    # Ten hours later, and after the watermark has passed their time, the agency's records are new again.
    assert kept == sorted([*first, message(500, dr_no="3"), message(600, dr_no="1"), message(600, dr_no="2")])


def test_tables_of_the_jobs_can_be_committed_and_compacted(spark, tmp_path, rows):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for i, minute in enumerate((0, 70, 200)):
        land(source, f"{i}.json", message(minute), message(minute))
        messages = stream_messages(spark, "text", str(source))
        jobs.start_hourly(messages, out, str(tmp_path / "cp"), fmt=jobs.COMMITTED, trigger=jobs.ONCE).awaitTermination()
    schema = T.StructType([*HOURLY.fields, T.StructField("day", T.DateType())])
    before = rows(read_committed(spark, out, schema), "window_start", "incident_count")
    assert [n for _, n in before] == [2, 2]
    assert compact(spark, out, schema, "day")
    assert rows(read_committed(spark, out, schema), "window_start", "incident_count") == before
