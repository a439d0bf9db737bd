"""Polls at a steady interval: of everything recent, or as a stream of what has landed since the last poll."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallywatch.plans.ingest import poll
from tallywatch.schema import TOPIC
from tallywatch.sinks.messages import to_messages
from tallywatch.sources.polls import stream_polls

EVERY = "1 hour"

log = logging.getLogger(__name__)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)


def start_polling(
    spark: SparkSession, landing: str, checkpoint: str, every: str = EVERY, fmt: str = "kafka", path: str | None = None,
    clock: Callable[[], datetime] = utc_now, limit: int | None = None, **options: str,
) -> StreamingQuery:
    """Poll every agency at once and then once per interval, until stopped.

    The ticks of a rate source set the pace. Each poll takes the last days again, so a record is sent as often as it is
    polled, and a batch that Spark repeats after a failure polls once more, at the time of the repetition. What goes
    wrong with one agency is logged and does not end the polling.
    """

    def one_poll(ticks: DataFrame, _: int) -> None:
        for name, problem in poll(ticks.sparkSession, landing, clock(), fmt, path, limit, **options).failed.items():
            log.warning("%s was not polled: %s", name, problem)

    ticks = spark.readStream.format("rate").load()
    writer = ticks.writeStream.foreachBatch(one_poll).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start()


def start_poll_stream(
    spark: SparkSession, landing: str, checkpoint: str, every: str = EVERY, fmt: str = "kafka", path: str | None = None,
    as_of: datetime | None = None, trigger: dict[str, Any] | None = None, **options: str,
) -> StreamingQuery:
    """Publish what has landed since the last poll, once per interval.

    A record is sent by the poll after its landing and by no other, and a batch that Spark repeats after a failure sends
    the same messages. A folder of text files leaves the files of unfinished batches out when Spark reads it;
    a topic may hold messages of both attempts.
    """
    records = to_messages(stream_polls(spark, landing, as_of))
    writer = records.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    writer = writer.options(**({"topic": TOPIC, **options} if fmt == "kafka" else options))
    writer = writer.trigger(**(trigger or {"processingTime": every}))
    return writer.start(path) if path else writer.start()
