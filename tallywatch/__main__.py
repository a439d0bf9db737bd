"""Jobs for spark-submit or python -m tallywatch: poll, stream, train, answer, score, report."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywatch.functions.times import on_report_days
from tallywatch.operators import reports
from tallywatch.operators.day_states import add_days
from tallywatch.operators.scoring import invalid_requests, score_counts, score_requests
from tallywatch.plans.ingest import poll
from tallywatch.plans.training import load_latest, save_model, save_run, train, train_by_days
from tallywatch.session import build_session
from tallywatch.sinks.tables import append, replace_days
from tallywatch.sources.messages import stream_messages
from tallywatch.sources.tables import read_score_requests, read_table, stream_score_requests
from tallywatch.streaming import jobs
from tallywatch.streaming.polling import start_poll_stream, start_polling
from tallywatch.streaming.progress import ProgressLog
from tallywatch.streaming.supervision import supervise


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def days_of(counts: DataFrame, since: date | None) -> DataFrame:
    """Counts from a day on; the filter is on the partitions, so older days are not opened."""
    return counts.filter(F.col("day") >= F.lit(since)) if since else counts


def run_poll(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.every and args.landed:
        start_poll_stream(
            spark, args.landing, args.checkpoint, args.every, args.messages, args.path, **_options(args.option)
        ).awaitTermination()
        return
    if args.every:
        start_polling(
            spark, args.landing, args.checkpoint, args.every, args.messages, args.path, limit=args.limit,
            **_options(args.option),
        ).awaitTermination()
        return
    polled = poll(spark, args.landing, args.as_of, args.messages, args.path, args.limit, **_options(args.option))
    for name, n in polled.counts.items():
        print(f"{name}: {n}")
    for name, problem in polled.failed.items():
        print(f"{name} failed: {problem}")


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = stream_messages(spark, args.messages, args.path, **_options(args.option))
    trigger = jobs.ONCE if args.once else {"processingTime": args.every} if args.every else None
    log = ProgressLog(spark, args.progress) if args.progress else None
    if log:
        spark.streams.addListener(log)

    def starter(name: str, start: Callable[..., StreamingQuery]) -> Callable[[], StreamingQuery]:
        return lambda: start(messages, f"{args.out}/{name}", f"{args.checkpoint}/{name}", fmt=args.format, trigger=trigger, name=name)

    queries = {"raw": jobs.start_raw, "hourly": jobs.start_hourly, "quarantine": jobs.start_quarantine}
    try:
        supervise({name: starter(name, start) for name, start in queries.items()}, budget=args.restarts)
    finally:
        if log:
            log.close()


def run_answer(spark: SparkSession, args: argparse.Namespace) -> None:
    model = load_latest(spark, args.models, args.default_model, fmt=args.format)
    trigger = jobs.ONCE if args.once else None
    requests = stream_score_requests(spark, args.requests)
    supervise({"answers": lambda: jobs.start_answers(requests, model, args.out, args.checkpoint, trigger, "answers")}, budget=args.restarts)


def run_train(spark: SparkSession, args: argparse.Namespace) -> None:
    hourly = read_table(spark, args.hourly, args.format)
    if args.states:
        add_days(spark, hourly, args.states, args.days)
        run = train_by_days(spark, args.states, since=args.since)
    else:
        run = train(days_of(hourly, args.since))
    save_run(spark, run, f"{args.models}/runs", args.format)
    print(save_model(spark, run, args.models, fmt=args.format))


def run_score(spark: SparkSession, args: argparse.Namespace) -> None:
    model = load_latest(spark, args.models, args.default_model, fmt=args.format)
    if args.requests:
        requests = read_score_requests(spark, args.requests)
        append(score_requests(requests, model), f"{args.out}/answers", args.format)
        append(invalid_requests(requests), f"{args.out}/invalid", args.format)
    else:
        counts = days_of(read_table(spark, args.hourly, args.format), args.since)
        replace_days(score_counts(counts, model), args.out, args.format)


def run_report(spark: SparkSession, args: argparse.Namespace) -> None:
    table = read_table(spark, args.scored, args.format)
    scored = reports.series_of(table)
    recent = reports.series_of(table.filter(on_report_days(F.col("day"), args.as_of, args.range)))
    picked = reports.for_place_and_type(recent, args.location, args.type)
    picked = reports.in_range(picked, args.as_of, args.range)
    reports.anomaly_metrics(picked, args.threshold).show()
    reports.type_distribution(scored, args.location).show()
    reports.score_histogram(picked).orderBy("bin").show()
    reports.recent_anomalies(picked, args.threshold).show()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallywatch", description=__doc__)
    top.add_argument("--master")
    top.add_argument("--format", default="parquet", help="table format; delta where its connector is installed")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, *required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def messages(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--messages", default="kafka", help="kafka, or text with --path")
        sub.add_argument("--path")
        sub.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")

    sub = command("poll", run_poll, "landing")
    when = sub.add_mutually_exclusive_group(required=True)
    when.add_argument("--as-of", type=datetime.fromisoformat, help="poll once, as if it were then")
    when.add_argument("--every", metavar="INTERVAL", help="poll at once and then per interval, such as '1 hour'")
    sub.add_argument("--checkpoint", help="folder that --every keeps its progress in")
    sub.add_argument("--limit", type=int, help="send only so many of the newest records of an agency polled by day")
    messages(sub)
    sub.add_argument("--landed", action="store_true", help="with --every: send each record once, by the poll after its landing")
    sub = command("stream", run_stream, "out", "checkpoint")
    messages(sub)
    sub.add_argument("--once", action="store_true", help="end when the input is used up")
    sub.add_argument("--progress", metavar="DIR", help="keep the numbers of each batch as a table")
    sub.add_argument("--restarts", type=int, default=3, help="how often a query may fail within an hour")
    sub.add_argument("--every", metavar="INTERVAL", help="start a batch per interval, such as '1 hour'")
    sub = command("train", run_train, "hourly", "models")
    sub.add_argument("--since", type=date.fromisoformat, help="leave out the days before")
    sub.add_argument("--states", metavar="DIR", help="keep the states of days here and train from them")
    sub.add_argument("--day", dest="days", type=date.fromisoformat, action="append", default=[], help="with --states: add this day first")
    sub = command("answer", run_answer, "models", "requests", "out", "checkpoint")
    sub.add_argument("--default-model")
    sub.add_argument("--once", action="store_true", help="end when the requests are used up")
    sub.add_argument("--restarts", type=int, default=3, help="how often the query may fail within an hour")
    sub = command("score", run_score, "models", "out")
    sub.add_argument("--since", type=date.fromisoformat, help="score the hours from this day on; they replace those of the table")
    sub.add_argument("--default-model")
    given = sub.add_mutually_exclusive_group(required=True)
    given.add_argument("--requests")
    given.add_argument("--hourly")
    sub = command("report", run_report, "scored", "location", "type")
    sub.add_argument("--as-of", type=datetime.fromisoformat, required=True)
    sub.add_argument("--range", default="7d")
    sub.add_argument("--threshold", type=float, default=reports.DEFAULT_THRESHOLD)
    return top


def main(argv: list[str] | None = None) -> None:
    arguments = parser()
    args = arguments.parse_args(argv)
    if args.command == "poll" and args.every and not args.checkpoint:
        arguments.error("--every needs --checkpoint")
    args.run(build_session(f"tallywatch {args.command}", args.master), args)


if __name__ == "__main__":
    main()
