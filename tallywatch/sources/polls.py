"""The landing folders as a stream of polls.

A Python data source plans a poll and reads lines; everything else, the parse included, stays with Spark. Its offset
holds the instant of the poll and, per agency, when and under which name the last file landed that a poll has published.
A poll takes the files that landed since, in the folders that a poll of that instant asks for. The driver lists these
folders and nothing else, the offset does not grow, and as the instant is part of it, a batch that Spark repeats
after a failure reads the same files and gives its records the same time.

Files must not change once they have landed. With `settleSeconds` a poll leaves files alone that are younger than that, for
file systems that tell times in whole seconds or that several writers with different clocks write to.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tallywatch.functions.times import previous_month_key
from tallywatch.operators.cities import with_city
from tallywatch.schema import CITIES, ENVELOPE, SOURCES, UK, UK_FIELDS
from tallywatch.sources.landing import LOOKBACK
from tallywatch.sources.messages import parse

FORMAT = "landing_polls"
# Columns of a poll's lines; the last three are those of the folders.
LINES = "value binary, agency string, polled_at long, lat string, lng string, month string"
RANGE_BYTES = 64 << 20
OPEN_BYTES = 1 << 20
BLOCK_BYTES = 1 << 20
# Names of files that can only be read from their beginning.
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")

# Names of object stores in Hadoop's paths and in Arrow's.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}

UTC = timezone.utc


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a Hadoop path, and the path on it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), os.path.abspath(path)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    try:
        return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as problem:
        raise ValueError(f"no way to read {scheme}: paths from Python: {problem}") from problem


@dataclass(frozen=True)
class Landed:
    """One file, with what its folders say."""

    landed: int
    path: str
    size: int
    lat: str | None = None
    lng: str | None = None
    month: str | None = None

    @property
    def place(self) -> list:
        """Where the file stands in the order of landing; the offset holds it as a JSON value."""
        return [self.landed, self.path]


@dataclass(frozen=True)
class Range:
    """Lines that begin in a range of bytes of a file; without an end, all of a compressed one."""

    path: str
    begin: int
    end: int | None
    folders: tuple[str | None, str | None, str | None]


@dataclass
class Lines(InputPartition):
    """What one task reads: ranges of files of one agency."""

    agency: str
    polled_at: int
    ranges: list[Range]


def packed(ranges: list[tuple[int, Range]], limit: int) -> Iterator[list[Range]]:
    """Consecutive ranges of together at most `limit` bytes, each file counted as a megabyte more."""
    held, size = [], 0
    for n, one in ranges:
        if held and size + n + OPEN_BYTES > limit:
            yield held
            held, size = [], 0
        held.append(one)
        size += n + OPEN_BYTES
    if held:
        yield held


def files_below(system: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """Data files anywhere below a folder; none if it is not there or cannot be listed."""
    try:
        found = system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
    except OSError:
        return []
    return [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")) and "/_" not in f.path[len(folder):]]


def folders_below(system: fs.FileSystem, folder: str, name: str) -> dict[str, str]:
    """Folders named `name=value` in a folder, by value."""
    try:
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    except OSError:
        return {}
    return {f.base_name.removeprefix(f"{name}="): f.path for f in found
            if f.type == fs.FileType.Directory and f.base_name.startswith(f"{name}=")}


class PollReader(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        self.root = options["path"].rstrip("/")
        self.as_of = options.get("asOf")
        self.settle = float(options.get("settleSeconds", "0"))
        self.lookback = timedelta(seconds=float(options.get("lookbackSeconds", str(LOOKBACK.total_seconds()))))
        self.cities = {tuple(c.split(",")) for c in options["cities"].split(";")}

    def now(self) -> datetime:
        at = datetime.fromisoformat(self.as_of) if self.as_of else datetime.now(UTC).replace(tzinfo=None)
        return at.replace(microsecond=0)

    def listed(self, agency: str, at: datetime) -> list[Landed]:
        """Files of the folders that a poll at this instant asks for, in the order of landing."""
        system, root = file_system(f"{self.root}/source={agency}")
        found = []
        if agency == UK.name:
            month = previous_month_key(at)
            for lat, lng in self.cities:
                for f in files_below(system, f"{root}/lat={lat}/lng={lng}/month={month}"):
                    found.append(Landed(f.mtime_ns, f.path, f.size, lat, lng, month))
        else:
            first = (at - self.lookback).date().isoformat()
            for day, folder in folders_below(system, root, "day").items():
                if day >= first:
                    found += [Landed(f.mtime_ns, f.path, f.size) for f in files_below(system, folder)]
        return sorted(found, key=lambda f: f.place)

    def initialOffset(self) -> dict:
        return {"polled_at": 0, **{s.name: {"month": "", "last": "[0, \"\"]"} for s in SOURCES}}

    def latestOffset(self) -> dict:
        at = self.now()
        until = (datetime.now(UTC).timestamp() - self.settle) * 1e9 if self.settle else float("inf")
        offset: dict = {"polled_at": int(at.replace(tzinfo=UTC).timestamp())}
        for source in SOURCES:
            settled = [f for f in self.listed(source.name, at) if f.landed <= until]
            month = previous_month_key(at) if source == UK else ""
            offset[source.name] = {"month": month, "last": json.dumps(settled[-1].place if settled else [0, ""])}
        return offset

    def partitions(self, start: dict, end: dict) -> list[Lines]:
        at = datetime.fromtimestamp(end["polled_at"], UTC).replace(tzinfo=None)
        out = []
        for source in SOURCES:
            before, until = start[source.name], end[source.name]
            # Another month means other folders, none of whose files a poll has seen.
            after = json.loads(before["last"]) if before["month"] == until["month"] else [0, ""]
            ranges = []
            for f in self.listed(source.name, at):
                if after < f.place <= json.loads(until["last"]):
                    step = max(1, f.size) if f.path.endswith(COMPRESSED) else RANGE_BYTES
                    for begin in range(0, f.size, step):
                        stop = None if f.path.endswith(COMPRESSED) else begin + step
                        ranges.append((min(step, f.size - begin), Range(f.path, begin, stop, (f.lat, f.lng, f.month))))
            out += [Lines(source.name, end["polled_at"], some) for some in packed(ranges, RANGE_BYTES)]
        return out

    def read(self, partition: Lines) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.root)
        schema = pa.schema([("value", pa.binary()), ("agency", pa.string()), ("polled_at", pa.int64()),
                            *((c, pa.string()) for c in ("lat", "lng", "month"))])
        for one in partition.ranges:
            said = (partition.agency, partition.polled_at, *one.folders)
            for lines in blocks_of_lines(system, one):
                columns = [pa.array([value] * len(lines), field.type) for value, field in zip(said, list(schema)[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), *columns], schema=schema)


def blocks_of_lines(system: fs.FileSystem, part: Range) -> Iterator[list[bytes]]:
    """The lines that begin in the range, some at a time. A line belongs to the range in which its first byte lies."""
    if part.end is None:
        with system.open_input_stream(part.path) as stream:
            yield from _lines(stream, 0, None, False)
        return
    with system.open_input_file(part.path) as file:
        begin = max(0, part.begin - 1)
        file.seek(begin)
        yield from _lines(file, begin, part.end, part.begin > 0)


def _lines(stream, at: int, end: int | None, inside: bool) -> Iterator[list[bytes]]:
    """Lines from position `at` on; with `inside` the first, which began before, is left to the range before."""
    rest, rest_at = b"", at
    while True:
        block = stream.read(BLOCK_BYTES)
        *lines, rest = (rest + block).split(b"\n") if block else (rest, b"")
        out = []
        for line in lines:
            if inside:
                inside = False
            elif end is not None and rest_at >= end:
                if out:
                    yield out
                return
            elif line.strip():
                out.append(line)
            rest_at += len(line) + 1
        if out:
            yield out
        if not block:
            return


class LandingPolls(DataSource):
    """Options: path (the landing folder), cities, asOf (an instant instead of now), settleSeconds, lookbackSeconds."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema: StructType) -> PollReader:
        return PollReader(self.options)


def stream_polls(
    spark: SparkSession, landing: str, as_of: datetime | None = None, cities: tuple = CITIES,
    lookback: timedelta = LOOKBACK, settle: timedelta = timedelta(0),
) -> DataFrame:
    """Records of all agencies as the polls of a stream take them: each landed record once, at the time of its poll.

    A batch is a poll, so the trigger sets the pace. Daily agencies give what is newer than the lookback, the UK last
    month's records of the polled cities. An agency whose folders are not there has no records.
    """
    spark.dataSource.register(LandingPolls)
    reader = spark.readStream.format(FORMAT).option("path", landing).option("settleSeconds", str(settle.total_seconds()))
    reader = reader.option("lookbackSeconds", str(lookback.total_seconds()))
    reader = reader.option("cities", ";".join(f"{lat},{lng}" for lat, lng, _ in cities))
    if as_of:
        reader = reader.option("asOf", as_of.isoformat())
    lines = reader.load()
    folders = {"poll_lat": "lat", "poll_lng": "lng", "poll_month": "month"}
    parsed = parse(lines.withColumnsRenamed({old: new for new, old in folders.items()}), ENVELOPE, "agency", "polled_at", *folders)
    place = {c: F.col(f"poll_{c}").cast("decimal(9,4)") for c in ("lat", "lng")}
    placed = with_city(parsed.withColumns(place), "city_name", cities)
    return placed.filter(_asked_for(lookback)).withColumns({
        "source": F.col("agency"), "timestamp": F.col("polled_at"),
        "location_name": F.when(F.col("agency") == UK.name, F.col("city_name")).otherwise(F.col("location_name")),
        "month": F.coalesce("poll_month", "month"),
    }).select(*ENVELOPE.fieldNames())


def _asked_for(lookback: timedelta) -> Column:
    """Daily records strictly newer than the lookback, and UK records of which a line says anything at all."""
    # The columns still have the names of the envelope, "source" among them, so the agency decides.
    happened = F.coalesce(*(F.when(F.col("agency") == s.name, F.col(s.date_field)) for s in SOURCES if s != UK))
    newest = F.timestamp_seconds(F.col("polled_at") - int(lookback.total_seconds())).cast("timestamp_ntz")
    said = F.coalesce(*(F.col(c).cast("string") for c in UK_FIELDS if c not in ("month", "location_name")))
    return F.when(F.col("agency") == UK.name, said.isNotNull()).otherwise(happened.try_cast("timestamp_ntz") > newest)
