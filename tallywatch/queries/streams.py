"""Streaming jobs run to the end of their input, and their tables read back.

The landing folder of each run is text files of raw messages. A job that is run more than once resumes from
its checkpoint, which also carries the watermark.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.functions.incidents import crime_type, place_name, record_id
from tallywatch.functions.times import day_of, instant
from tallywatch.queries import sql, views
from tallywatch.queries.registry import query
from tallywatch.schema import CHICAGO, ENVELOPE, HOURLY_KEY, LA, NYC, SOURCES, UK, Source
from tallywatch.session import new_folder, remove_folder
from tallywatch.sinks.commits import DATA, batch_name, compact, once_per_batch, read_committed, remove_replaced, write_rows
from tallywatch.sinks.messages import publish, to_messages
from tallywatch.sources.landing import extract_all
from tallywatch.sources.messages import parse, read_messages, stream_messages
from tallywatch.sources.tables import read_table
from tallywatch.streaming import jobs
from tallywatch.streaming.polling import start_poll_stream
from tallywatch.streaming.progress import INPUT_ROWS, STATE_ROWS, ProgressLog, read_progress
from tallywatch.streaming.state import open_hours
from tallywatch.streaming.supervision import supervise

CUT = datetime(2024, 1, 16)
HELD_TYPE = "purchase"


def run_once(start, spark: SparkSession, landing: str, out: str, checkpoint: str, **settings) -> None:
    """Run one job over what its landing folder holds by now."""
    messages = stream_messages(spark, "text", landing)
    start(messages, out, checkpoint, trigger=jobs.ONCE, **settings).awaitTermination()


def streamed(start, spark: SparkSession, batches: list[DataFrame], **settings) -> DataFrame:
    """Land one batch of messages after the other, run the job on each, and read what it wrote."""
    landing, out, checkpoint = (new_folder(spark, label) for label in ("messages", "stream", "checkpoint"))
    for batch in batches:
        batch.write.mode("append").text(landing)
        run_once(start, spark, landing, out, checkpoint, **settings)
    return read_table(spark, out).drop("day")


_MESSAGE_TEXT = f"""WITH {sql.MESSAGES}, fields AS (
  SELECT *, '"source":"' || source || '","timestamp":' || "timestamp" AS head,
         '"location":{{"latitude":"' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || '","street":{{"id":' || user_id
           || ',"name":"' || event_type || '"}}}}' AS spot,
         '"id":"' || event_id || '"' AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS happened
  FROM messages)
SELECT '{{' || head || CASE source
  WHEN 'uk_police' THEN ',' || spot || ',"category":"' || crime_type || '","location_name":"' || location_name
    || '",' || id || ',"month":"' || strftime(ts, '%Y-%m') || '"'
  WHEN 'chicago' THEN ',' || spot || ',' || id || ',"primary_type":"' || crime_type || '","district":"' || location_name
    || '","case_number":"' || event_id || '","date":"' || happened || '"'
  WHEN 'nyc' THEN ',' || id || ',"ofns_desc":"' || crime_type || '","boro_nm":"' || location_name
    || '","cmplnt_num":"' || event_id || '","cmplnt_fr_dt":"' || happened || '"'
  WHEN 'la' THEN ',' || id || ',"crm_cd_desc":"' || crime_type || '","area_name":"' || location_name
    || '","dr_no":"' || event_id || '","date_rptd":"' || happened || '"'
  ELSE '' END || '}}' AS value
FROM fields"""


@query(_MESSAGE_TEXT)
def stream_source_messages(spark, sf_dir):
    return streamed(jobs.start_messages, spark, [views.raw_messages(spark, sf_dir)])


def _hourly(spark: SparkSession, batches: list[DataFrame]) -> DataFrame:
    return streamed(jobs.start_hourly, spark, batches, state_partitions=spark.sparkContext.defaultParallelism)


def _raw_sql(source: Source) -> str:
    return f"""WITH {sql.ROUTED}
SELECT source, "timestamp", event_time, crime_type, CAST(event_id AS VARCHAR) AS id,
       crime_type AS {source.type_field}, location_name AS {source.place_field}
FROM routed WHERE source = '{source.name}'"""


def _raw(spark, sf_dir, source: Source) -> DataFrame:
    table = streamed(jobs.start_raw, spark, [views.raw_messages(spark, sf_dir)], sources=[source.name])
    wanted = dict.fromkeys(["source", "timestamp", "event_time", "crime_type", "id", source.type_field, source.place_field])
    assert set(table.columns) == {*ENVELOPE.fieldNames(), "event_time", "crime_type"}
    return table.filter(F.col("source") == source.name).select(*wanted)


@query(_raw_sql(UK))
def stream_raw_uk(spark, sf_dir):
    return _raw(spark, sf_dir, UK)


@query(_raw_sql(CHICAGO))
def stream_raw_chicago(spark, sf_dir):
    return _raw(spark, sf_dir, CHICAGO)


@query(_raw_sql(NYC))
def stream_raw_nyc(spark, sf_dir):
    return _raw(spark, sf_dir, NYC)


@query(_raw_sql(LA))
def stream_raw_la(spark, sf_dir):
    return _raw(spark, sf_dir, LA)


@query(f"WITH {sql.CLOSED} SELECT * FROM closed")
def stream_hourly_counts(spark, sf_dir):
    """Hourly counts in append mode: only windows the watermark has closed are written."""
    return _hourly(spark, [views.raw_messages(spark, sf_dir)])


def _messages_where(spark, sf_dir, condition) -> DataFrame:
    return to_messages(views.source_records(spark, sf_dir).filter(condition))


def _happened_before(cut: datetime):
    return F.timestamp_seconds("timestamp").cast("timestamp_ntz") < instant(cut)


@query(f"WITH {sql.CLOSED} SELECT * FROM closed")
def stream_restart(spark, sf_dir):
    """The same table from a job that was stopped halfway and resumed: nothing lost, nothing repeated."""
    early = _happened_before(CUT)
    halves = [_messages_where(spark, sf_dir, condition) for condition in (early, ~early)]
    return _hourly(spark, halves)


# Polls in which one type of the first half arrives late, and the watermarks after the first and the last.
LATE_POLLS = f"""polls AS (
  SELECT *, CASE WHEN event_time >= TIMESTAMP '2024-01-16' THEN 3
                 WHEN crime_type = '{HELD_TYPE}' AND {sql.KNOWN} THEN 2 ELSE 1 END AS poll,
         date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end
  FROM messages),
watermark AS (SELECT max(event_time) FILTER (WHERE poll = 1) - INTERVAL 1 HOUR AS after_first,
                     max(event_time) - INTERVAL 1 HOUR AS at_end FROM polls WHERE {sql.KNOWN})"""


def _late_polls(spark, sf_dir) -> list[DataFrame]:
    early = _happened_before(CUT)
    kind = F.coalesce("category", "primary_type", "ofns_desc", "crm_cd_desc")
    held = F.coalesce(kind == HELD_TYPE, F.lit(False))
    return [_messages_where(spark, sf_dir, condition) for condition in (early & ~held, early & held, ~early)]


@query(f"""WITH {sql.MESSAGES}, {LATE_POLLS}
SELECT window_start, window_end, source, location_name, crime_type, count(*) AS incident_count
FROM polls, watermark
WHERE {sql.KNOWN} AND window_end <= at_end AND NOT (poll = 2 AND window_end <= after_first)
GROUP BY ALL""")
def stream_late_data(spark, sf_dir):
    """One type of the first half arrives a poll late: its rows in closed windows are dropped, the rest count."""
    return _hourly(spark, _late_polls(spark, sf_dir))


@query(f"""WITH {sql.MESSAGES}, {LATE_POLLS}, numbers AS (
  SELECT poll, count(*) AS input_rows, count(*) FILTER (WHERE {sql.KNOWN}) AS total,
         {", ".join(f"count(*) FILTER (WHERE source = '{s.name}') AS {s.name}" for s in SOURCES)},
         count(DISTINCT (window_start, source, location_name, crime_type))
           FILTER (WHERE {sql.KNOWN} AND poll = 2 AND window_end <= after_first) AS late_groups
  FROM polls, watermark GROUP BY poll)
{" UNION ALL ".join(
    f"SELECT '{name}' AS query, poll::INTEGER AS poll, '{metric}' AS metric, ({value})::BIGINT AS value FROM numbers"
    for name, metric, value in [
        *((job, "input_rows", "input_rows") for job in ("raw", "quarantine", "hourly")), ("raw", "ingest.total", "total"),
        *(("raw", f"ingest.{s.name}", s.name) for s in SOURCES), ("quarantine", "quarantine.n", "input_rows - total"),
        ("hourly", "late_groups", "late_groups")])}""")
def stream_progress(spark, sf_dir):
    """What the raw, the quarantine and the hourly query report of these polls: rows read, records per source, records set
    aside and groups that came too late."""
    folder = new_folder(spark, "progress")
    log = ProgressLog(spark, folder)
    spark.streams.addListener(log)
    try:
        landing = new_folder(spark, "messages")
        jobs_by_name = {"raw": jobs.start_raw, "quarantine": jobs.start_quarantine, "hourly": jobs.start_hourly}
        places = {name: [new_folder(spark, f"{name}-{label}") for label in ("stream", "checkpoint")] for name in jobs_by_name}
        for batch in _late_polls(spark, sf_dir):
            batch.write.mode("append").text(landing)
            for name, start in jobs_by_name.items():
                messages = stream_messages(spark, "text", landing)
                running = start(messages, *places[name], trigger=jobs.ONCE, name=name)
                running.awaitTermination()
                if not log.wait_for(running):
                    raise TimeoutError(f"the progress of {name} did not arrive")
    finally:
        spark.streams.removeListener(log)
    table = read_progress(spark, folder).filter(F.col("metric") != STATE_ROWS)
    # Batches without input close windows; those with input are the polls.
    read = table.filter((F.col("metric") == INPUT_ROWS) & (F.col("value") > 0)).select("query", "batch_id")
    poll = F.row_number().over(Window.partitionBy("query").orderBy("batch_id"))
    return table.join(read.withColumn("poll", poll), ["query", "batch_id"]).select("query", "poll", "metric", "value")


@query(f"""WITH {sql.HOURLY}
SELECT *, window_end > (SELECT max(event_time) FROM routed) - INTERVAL 1 HOUR AS open FROM hourly""")
def stream_open_hours(spark, sf_dir):
    """All hours: those the hourly query has written, and those it still holds open in its state."""
    landing, out, checkpoint = (new_folder(spark, label) for label in ("messages", "stream", "checkpoint"))
    views.raw_messages(spark, sf_dir).write.text(landing)
    run_once(jobs.start_hourly, spark, landing, out, checkpoint, state_partitions=spark.sparkContext.defaultParallelism)
    closed = read_table(spark, out).drop("day").withColumn("open", F.lit(False))
    return closed.unionByName(open_hours(spark, checkpoint).withColumn("open", F.lit(True)))


POLLS = (datetime(2024, 1, 16), datetime(2024, 1, 19), datetime(2024, 1, 31))


@query(f"""WITH {sql.POINTS}, {sql.ROUTED}, landed AS (
  SELECT routed.*, city, CASE WHEN event_time >= TIMESTAMP '2024-01-16' THEN 2 WHEN crime_type = '{HELD_TYPE}' THEN 1 ELSE 0 END AS part
  FROM routed JOIN points USING (event_id) LEFT JOIN cities USING (lat, lng)),
polls(part, polled_at) AS (VALUES {", ".join(f"({i}, TIMESTAMP '{at}')" for i, at in enumerate(POLLS))})
SELECT source, CAST(event_id AS VARCHAR) AS record_id, polled_at, crime_type,
       CASE WHEN source = 'uk_police' THEN city ELSE location_name END AS location_name
FROM landed JOIN polls USING (part)
WHERE CASE WHEN source = 'uk_police' THEN city IS NOT NULL
           ELSE date_trunc('millisecond', ts) > polled_at - INTERVAL 7 DAY END""")
def poll_stream(spark, sf_dir):
    """Three polls, before each of which more has landed, of days that an earlier poll has read, too. The second one fails
    after its sink has written and before Spark has noted that, and is repeated days later, when more has landed."""
    folder, out, checkpoint = (new_folder(spark, label) for label in ("landing", "polled", "checkpoint"))
    happened = F.timestamp_seconds(views.epoch()).cast("timestamp_ntz")
    early, held = happened < instant(CUT), F.col("event_type") == HELD_TYPE
    for number, (at, part) in enumerate(zip(POLLS, (early & ~held, early & held, ~early))):
        views.land_events(spark, sf_dir, folder, part)
        # A run that finds a batch without its commit repeats it and does no more.
        for _ in range(2 if number == 2 else 1):
            start_poll_stream(spark, folder, checkpoint, fmt="text", path=out, as_of=at, trigger=jobs.ONCE).awaitTermination()
        if number == 1:
            remove_folder(spark, f"{checkpoint}/commits/{number}")
            remove_folder(spark, f"{out}/_spark_metadata/{number}")
    sent = parse(read_messages(spark, "text", out), ENVELOPE)
    return sent.select(
        "source", record_id().alias("record_id"), F.timestamp_seconds("timestamp").alias("polled_at"),
        crime_type().alias("crime_type"), place_name().alias("location_name"))


class SinkFailed(Exception):
    """Thrown on purpose."""


def _published(spark, landing: str, out: str, checkpoint: str, dies: set[int]):
    """Start a query that appends messages once per batch. In each of the batches named its sink dies once, when the rows
    are written and nothing says so yet."""
    once = once_per_batch(out, "messages")

    def sink(frame: DataFrame, number: int) -> None:
        if number in dies:
            dies.remove(number)
            write_rows({DATA: frame}, out, batch_name("messages", number))
            raise SinkFailed(f"batch {number}")
        once(frame, number)

    writer = stream_messages(spark, "text", landing).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(**jobs.ONCE).start()


@query(_MESSAGE_TEXT)
def append_exactly_once(spark, sf_dir):
    """Messages of three polls appended by a sink that dies before it commits the second batch, and whose third batch Spark
    runs twice because it lost its own note of it."""
    landing, out, checkpoint = (new_folder(spark, label) for label in ("messages", "published", "checkpoint"))
    dies = {1}
    for number, batch in enumerate(_late_polls(spark, sf_dir)):
        batch.write.mode("append").text(landing)
        for _ in range(2):
            try:
                _published(spark, landing, out, checkpoint, dies).awaitTermination()
            except StreamingQueryException as problem:
                if SinkFailed.__name__ not in str(problem):
                    raise
            if number == 2:
                remove_folder(spark, f"{checkpoint}/commits/{number}")
    return read_committed(spark, out, "value string")


@query(f"""WITH {sql.CLOSED}
SELECT 'raw' AS query, 0 AS restarts, (SELECT count(*) FROM routed) AS n_rows
UNION ALL SELECT 'hourly', 0, (SELECT count(*) FROM closed)
UNION ALL SELECT 'messages', 1, (SELECT count(*) FROM messages)""")
def supervised_run(spark, sf_dir):
    """Three queries under supervision, one of which fails once and is started again: how often, and the rows of each."""
    landing = new_folder(spark, "messages")
    views.raw_messages(spark, sf_dir).write.text(landing)
    out, checkpoint = ({name: new_folder(spark, label) for name in ("raw", "hourly", "messages")} for label in ("out", "checkpoint"))
    dies = {0}

    def start(name: str, job):
        return lambda: job(stream_messages(spark, "text", landing), out[name], checkpoint[name], trigger=jobs.ONCE, name=name)

    outcome = supervise({
        "raw": start("raw", jobs.start_raw), "hourly": start("hourly", jobs.start_hourly),
        "messages": lambda: _published(spark, landing, out["messages"], checkpoint["messages"], dies)})
    rows = {"raw": read_table(spark, out["raw"]), "hourly": read_table(spark, out["hourly"]),
            "messages": read_committed(spark, out["messages"], "value string")}
    found = [(name, n, rows[name].count()) for name, n in outcome.restarts.items()]
    return spark.createDataFrame(found, "query string, restarts int, n_rows bigint")


UNIQUE_POLLS = (datetime(2024, 1, 20), datetime(2024, 1, 23))


@query(f"""WITH {sql.ROUTED}, polls(polled_at) AS (VALUES {", ".join(f"(TIMESTAMP '{at}')" for at in UNIQUE_POLLS)})
SELECT source, CAST(event_id AS VARCHAR) AS record_id, min(polled_at) AS polled_at
FROM routed, polls
WHERE source <> 'uk_police' AND date_trunc('millisecond', ts) > polled_at - INTERVAL 7 DAY
  AND CAST(ts AS DATE) <= CAST(polled_at AS DATE) + 1
GROUP BY ALL""")
def stream_unique(spark, sf_dir):
    """Two polls of the last seven days, most of whose records are the same: each record once, as the first poll sent it."""
    folder = views.landing(spark, sf_dir)
    landing, out, checkpoint = (new_folder(spark, label) for label in ("messages", "unique", "checkpoint"))
    for at in UNIQUE_POLLS:
        publish(extract_all(spark, folder, at), "text", landing)
        run_once(jobs.start_unique, spark, landing, out, checkpoint)
    sent = parse(read_messages(spark, "parquet", out), ENVELOPE)
    return sent.select("source", record_id().alias("record_id"), F.timestamp_seconds("timestamp").alias("polled_at"))


@query(f"WITH {sql.HOURLY} SELECT * FROM hourly")
def table_compaction(spark, sf_dir):
    """Hourly counts appended in five batches to a table by day, compacted after the fourth. Every day then has a file of the
    four batches and one of the last, and the old files go."""
    out = new_folder(spark, "hourly")
    counts = views.hourly_table(spark, sf_dir).withColumn("day", day_of(F.col("window_start"))).repartition(8)
    part = F.pmod(F.xxhash64(*HOURLY_KEY), F.lit(5))
    for number in range(5):
        once_per_batch(out, "hourly", "parquet", "day")(counts.filter(part == number), number)
        if number == 3 and not (compact(spark, out, counts.schema, "day") and remove_replaced(spark, out) == 4):
            raise RuntimeError("the table was not compacted")
    table = read_committed(spark, out, counts.schema)
    files = table.select("day", F.input_file_name().alias("file")).filter(F.col("file").contains("compacted"))
    if files.groupBy("day").agg(F.count_distinct("file").alias("n")).filter("n > 1").count():
        raise RuntimeError("a day of few bytes has several compacted files")
    return table.drop("day")
