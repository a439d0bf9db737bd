"""The ingest queries and the scoring query.

Raw records, hourly counts and the quarantine each read the source on their own: one full parse for the raw tables,
which are a single table partitioned by source and day, and narrow parses for the other two. Counts are partitioned
by the day their window begins on. Every start function returns the running query; pass
trigger={"availableNow": True} for a run that ends when the input is used up, and fmt="committed" for a table whose
files can be compacted while the query runs.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywatch.functions.incidents import known_source, record_id, source_counts
from tallywatch.functions.times import day_of
from tallywatch.operators.aggregates import hourly_counts
from tallywatch.operators.normalize import quarantine, routed, unify, with_event_time
from tallywatch.operators.scoring import Model, invalid_requests, score_counts, score_requests
from tallywatch.schema import ID_ENVELOPE, SOURCE_NAMES
from tallywatch.sinks.commits import append_once, batch_name, once_per_batch
from tallywatch.sources.messages import parse, parse_narrow

REMEMBERED = "7 days"
ANSWERS, REJECTS = "answers", "rejects"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
ONCE: dict[str, Any] = {"availableNow": True}
# Table format of sinks.commits: parquet, each batch a commit, which compaction can bring together.
COMMITTED = "committed"


def _start(
    frame: DataFrame, path: str, checkpoint: str, fmt: str, trigger: dict[str, Any] | None, name: str | None, *partitions: str
) -> StreamingQuery:
    writer = frame.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    if fmt == COMMITTED:
        return writer.foreachBatch(once_per_batch(path, "stream", "parquet", *partitions)).start()
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.format(fmt).start(path)


def start_messages(
    messages: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: dict[str, Any] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Keep the messages as they came."""
    return _start(messages, path, checkpoint, fmt, trigger, name)


def start_raw(
    messages: DataFrame, path: str, checkpoint: str, sources: Iterable[str] = SOURCE_NAMES,
    fmt: str = "parquet", trigger: dict[str, Any] | None = None, name: str | None = None,
) -> StreamingQuery:
    """All fields of every routed record, one partition per source and day of its event time.

    The progress of each batch carries its records per source as the observed metrics "ingest".
    """
    records = routed(parse(messages), sources).observe("ingest", *source_counts())
    records = records.withColumn("day", day_of(F.col("event_time")))
    return _start(records, path, checkpoint, fmt, trigger, name, "source", "day")


def start_quarantine(
    messages: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: dict[str, Any] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """The messages that do not count, as they came, with the reason.

    The progress of each batch carries their number as the observed metric "quarantine".
    """
    aside = quarantine(parse_narrow(messages, "value")).select(
        F.col("value").cast("string").alias("message"), "source", "timestamp", "reason"
    )
    aside = aside.observe("quarantine", F.count("*").alias("n"))
    return _start(aside, path, checkpoint, fmt, trigger, name, "reason")


def start_hourly(
    messages: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None,
    fmt: str = "parquet", trigger: dict[str, Any] | None = None, name: str | None = None, files_per_day: int = 1,
) -> StreamingQuery:
    """Hourly counts, each window written once after the watermark has passed its end.

    The first start fixes the number of state partitions for the life of the checkpoint. Without
    state_partitions it is the session's spark.sql.shuffle.partitions. The number is a setting of the session while the
    query starts, so start one query at a time in a session.

    The counts of a batch are brought together by day before they are written, or each state partition would leave a file
    in every day of the batch. A day that closes tens of millions of counts at once wants more than one of files_per_day.
    """
    conf = messages.sparkSession.conf
    usual = conf.get(SHUFFLE_PARTITIONS)
    conf.set(SHUFFLE_PARTITIONS, str(state_partitions or usual))
    try:
        counts = hourly_counts(unify(parse_narrow(messages))).withColumn("day", day_of(F.col("window_start")))
        share = F.pmod(F.xxhash64("source", "location_name", "crime_type"), F.lit(files_per_day))
        return _start(counts.repartition("day", share), path, checkpoint, fmt, trigger, name, "day")
    finally:
        conf.set(SHUFFLE_PARTITIONS, usual)


def start_scores(
    counts: DataFrame, model: Model, path: str, checkpoint: str, fmt: str = "parquet",
    trigger: dict[str, Any] | None = None, name: str | None = None,
) -> StreamingQuery:
    """Scores for a stream of hourly counts, by the same function as a batch."""
    return _start(score_counts(counts, model), path, checkpoint, fmt, trigger, name)


def start_unique(
    messages: DataFrame, path: str, checkpoint: str, remembered: str = REMEMBERED, fmt: str = "parquet",
    trigger: dict[str, Any] | None = None, name: str | None = None,
) -> StreamingQuery:
    """The messages without repeats, as they came: a record of an agency is known for at least the time `remembered` after
    its first poll, and until the watermark has passed that. The other jobs can read what this one writes.

    Records are told apart by the agency's own id, those without one by their whole text. What is remembered is one id per
    record of that time, off the heap. Messages without a usable time or of an unknown source are left to the quarantine.
    """
    parsed = parse(messages, ID_ENVELOPE, "value")
    known = with_event_time(parsed.filter(known_source())).filter(F.col("event_time").isNotNull())
    text = F.col("value").cast("string")
    known = known.select(text.alias("value"), "source", "event_time", F.coalesce(record_id(), F.sha2(text, 256)).alias("record_id"))
    unique = known.withWatermark("event_time", remembered).dropDuplicatesWithinWatermark(["source", "record_id"])
    return _start(unique.select("value"), path, checkpoint, fmt, trigger, name)


def start_answers(
    requests: DataFrame, model: Model, path: str, checkpoint: str, trigger: dict[str, Any] | None = None, name: str | None = None,
) -> StreamingQuery:
    """Answer a stream of score requests; those that cannot be answered go to a table of their own, with the field that is
    to blame.

    Both tables, ANSWERS and REJECTS of `path`, take a batch together and once, however often Spark runs it.
    """

    def write(frame: DataFrame, number: int) -> None:
        frame = frame.persist()
        try:
            both = {ANSWERS: score_requests(frame, model), REJECTS: invalid_requests(frame)}
            append_once(both, path, batch_name("requests", number))
        finally:
            frame.unpersist()

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(**trigger) if trigger else writer).start()


def await_all(spark: SparkSession) -> None:
    """Return when any query ends, and raise if it failed, so that no failure goes unnoticed."""
    spark.streams.awaitAnyTermination()
