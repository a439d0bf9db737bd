"""The reader of the polling source, by itself."""

import gzip
import os
import random
from datetime import datetime

import pytest

from tallywatch.schema import CITIES
from tallywatch.sources import polls
from tallywatch.sources.polls import Lines, PollReader, Range, blocks_of_lines, file_system, packed

CITY = ";".join(f"{lat},{lng}" for lat, lng, _ in CITIES)
LONDON = "lat=51.5074/lng=-0.1278"


@pytest.fixture()
def land(tmp_path):
    """Land a file of lines at a second of its own."""
    clock = iter(range(1_700_000_000, 1_700_001_000))

    def write(path, *lines, name="part-0.txt", at=None):
        file = tmp_path / path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("".join(f"{line}\n" for line in lines))
        at = at or next(clock)
        os.utime(file, (at, at))

    return write


def reader(tmp_path, at, **options):
    return PollReader({"path": str(tmp_path), "asOf": at, "cities": CITY, **options})


def read(tmp_path, at, start, end):
    source = reader(tmp_path, at)
    batches = [b for part in source.partitions(start, end) for b in source.read(part)]
    return sorted(line.decode() for b in batches for line in b["value"].to_pylist())


def test_every_landed_line_is_read_by_one_poll(tmp_path, land):
    land("source=nyc/day=2024-01-10", "n1", "n2")
    land(f"source=uk_police/{LONDON}/month=2023-12", "u1")
    land("source=uk_police/lat=1.0/lng=2.0/month=2023-12", "elsewhere")
    land("source=nyc/day=2023-12-01", "old")
    first = reader(tmp_path, "2024-01-12T10:00:00")
    zero, one = first.initialOffset(), first.latestOffset()
    assert read(tmp_path, "2024-01-12T10:00:00", zero, one) == ["n1", "n2", "u1"]
    # More lands: a file of the same day, one of a day that was read, one of a day to come.
    land("source=nyc/day=2024-01-10", "n3", name="part-1.txt")
    land("source=la/day=2024-01-08", "l1")
    land("source=la/day=2024-03-01", "l2")
    two = reader(tmp_path, "2024-01-12T11:00:00").latestOffset()
    assert read(tmp_path, "2024-01-12T11:00:00", one, two) == ["l1", "l2", "n3"]
    # A repeated batch reads what its offsets say, whatever has landed since and whatever the time is.
    land("source=la/day=2024-01-08", "l3", name="part-1.txt")
    assert read(tmp_path, "2024-01-14T00:00:00", one, two) == ["l1", "l2", "n3"]
    three = reader(tmp_path, "2024-01-12T12:00:00").latestOffset()
    assert read(tmp_path, "2024-01-12T12:00:00", two, three) == ["l3"]
    assert read(tmp_path, "2024-01-12T12:00:00", three, three) == []


def test_the_month_before_is_read_when_the_month_turns(tmp_path, land):
    land(f"source=uk_police/{LONDON}/month=2024-01", "january", at=1_700_000_010)
    land(f"source=uk_police/{LONDON}/month=2023-12", "december", at=1_700_000_020)
    one = reader(tmp_path, "2024-01-31T23:00:00").latestOffset()
    two = reader(tmp_path, "2024-02-01T00:00:00").latestOffset()
    start = reader(tmp_path, "2024-01-31T23:00:00").initialOffset()
    assert read(tmp_path, "2024-01-31T23:00:00", start, one) == ["december"]
    assert read(tmp_path, "2024-02-01T00:00:00", one, two) == ["january"]


def test_an_agency_that_is_quiet_for_long_repeats_nothing(tmp_path, land):
    land("source=la/day=2024-01-01", "l1")
    offsets = [reader(tmp_path, "2024-01-02T00:00:00").initialOffset()]
    got = []
    for at, line in (("2024-01-02T00:00:00", None), ("2024-01-20T00:00:00", None), ("2024-01-20T01:00:00", "l2"), ("2024-01-20T02:00:00", None)):
        if line:
            land("source=la/day=2024-01-19", line)
        offsets.append(reader(tmp_path, at).latestOffset())
        got.append(read(tmp_path, at, *offsets[-2:]))
    assert got == [["l1"], [], ["l2"], []]


def test_files_settle_first(tmp_path, land):
    now = datetime.now().timestamp()
    land("source=la/day=2024-01-01", "before", at=now - 100)
    land("source=la/day=2024-01-01", "fresh", name="part-1.txt", at=now)
    source = reader(tmp_path, "2024-01-02T00:00:00", settleSeconds="50")
    assert read(tmp_path, "2024-01-02T00:00:00", source.initialOffset(), source.latestOffset()) == ["before"]


def test_nothing_there(tmp_path):
    source = reader(tmp_path / "none", "2024-01-02T00:00:00")
    assert source.partitions(source.initialOffset(), source.latestOffset()) == []


@pytest.mark.parametrize("block", [3, 64, 1 << 20])
def test_ranges_cover_every_line_once(tmp_path, monkeypatch, block):
    monkeypatch.setattr(polls, "BLOCK_BYTES", block)
    rng = random.Random(block)
    for ending in ("\n", ""):
        lines = ["é" * rng.randrange(0, 9) + str(i) for i in range(80)] + ["", "x" * 200, "", "end"]
        path = tmp_path / "f.txt"
        path.write_text("\n".join(lines) + ending)
        size = path.stat().st_size
        system, name = file_system(str(path))
        for step in (1, 7, 50, size, size + 9):
            got = []
            for begin in range(0, size, step):
                got += [x.decode() for part in blocks_of_lines(system, Range(name, begin, begin + step, (None,) * 3)) for x in part]
            assert got == [line for line in lines if line]


def test_compressed_files_are_read_from_their_beginning(tmp_path):
    folder = tmp_path / "source=la/day=2024-01-01"
    folder.mkdir(parents=True)
    with gzip.open(folder / "part-0.txt.gz", "wt") as file:
        file.write("a\nb\n")
    (folder / "_SUCCESS").touch()
    (folder / ".part-0.txt.gz.crc").write_text("x")
    source = reader(tmp_path, "2024-01-02T00:00:00")
    assert read(tmp_path, "2024-01-02T00:00:00", source.initialOffset(), source.latestOffset()) == ["a", "b"]


def test_small_files_share_a_task_and_large_ones_are_cut(tmp_path, land, monkeypatch):
    monkeypatch.setattr(polls, "RANGE_BYTES", 100)
    monkeypatch.setattr(polls, "OPEN_BYTES", 10)
    land("source=la/day=2024-01-01", *["x" * 49] * 10)
    for i in range(6):
        land("source=la/day=2024-01-02", "abc", name=f"part-{i}.txt")
    source = reader(tmp_path, "2024-01-02T00:00:00")
    parts = source.partitions(source.initialOffset(), source.latestOffset())
    assert all(isinstance(p, Lines) for p in parts) and [len(p.ranges) for p in parts] == [1] * 5 + [6]
    assert list(packed([], 5)) == []


def test_paths_of_file_systems():
    for path in ("/a/b", "file:/a/b", "file:///a/b"):
        assert file_system(path)[1] == "/a/b"
    with pytest.raises(ValueError, match="nosuch"):
        file_system("nosuch://bucket/x")
