"""Extracts from landing folders."""

import json
import time
from datetime import datetime, timedelta
from decimal import Decimal

from tallywatch.plans.ingest import poll
from tallywatch.streaming.polling import start_polling
from tallywatch.schema import CHICAGO, CITIES, NYC
from tallywatch.sources.landing import extract_recent, extract_uk
from tallywatch.sources.messages import parse, read_messages

AS_OF = datetime(2024, 2, 10, 12, 0, 0)


def land(folder, *records):
    folder.mkdir(parents=True)
    (folder / "part.json").write_text("".join((r if r == "junk" else json.dumps(r)) + "\n" for r in records))


def chicago(root, day, *records):
    land(root / "source=chicago" / f"day={day}", *records)


def test_lookback_is_strict_and_limit_keeps_the_newest(spark, tmp_path):
    chicago(tmp_path, "2024-02-03",
            {"case_number": "edge", "date": "2024-02-03T12:00:00.000"},
            {"case_number": "in", "date": "2024-02-03T12:00:00.001", "source": "x", "timestamp": 1})
    chicago(tmp_path, "2024-02-09",
            {"case_number": "b", "date": "2024-02-09T00:00:00.000"},
            {"case_number": "a", "date": "2024-02-09T00:00:00.000"},
            {"case_number": "bad", "date": "soon"})
    found = extract_recent(spark, str(tmp_path), CHICAGO, AS_OF).collect()
    assert {r["case_number"] for r in found} == {"in", "a", "b"}
    assert {(r["source"], r["timestamp"]) for r in found} == {("chicago", 1707566400)}
    two = extract_recent(spark, str(tmp_path), CHICAGO, AS_OF, limit=2).collect()
    assert [r["case_number"] for r in two] == ["a", "b"]
    one = extract_recent(spark, str(tmp_path), CHICAGO, AS_OF, limit=1).collect()
    assert [r["case_number"] for r in one] == ["a"]


def test_days_out_of_range_are_not_read(spark, tmp_path):
    chicago(tmp_path, "2024-01-01", {"case_number": "old", "date": "2024-01-01T00:00:00"})
    chicago(tmp_path, "2024-02-10", {"case_number": "new", "date": "2024-02-10T00:00:00"})
    found = extract_recent(spark, str(tmp_path), CHICAGO, AS_OF)
    assert {p.split("/")[-2] for p in found.inputFiles()} == {"day=2024-02-10"}
    assert [r["case_number"] for r in found.collect()] == ["new"]


def test_without_a_limit_all_records_are_polled_and_none_sorted(spark, tmp_path):
    chicago(tmp_path, "2024-02-09", *({"case_number": str(i), "date": "2024-02-09T00:00:00"} for i in range(1500)))
    found = extract_recent(spark, str(tmp_path), CHICAGO, AS_OF)
    assert found.count() == 1500
    assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()
    polled = poll(spark, str(tmp_path), AS_OF, "text", str(tmp_path / "all"))
    assert polled.counts["chicago"] == polled.counts["total"] == 1500
    assert poll(spark, str(tmp_path), AS_OF, "text", str(tmp_path / "some"), limit=3).counts["total"] == 3


def test_own_cities_are_named_and_counted(spark, tmp_path):
    cities = [(Decimal("48.8566"), Decimal("2.3522"), "Paris")]
    uk = tmp_path / "source=uk_police"
    land(uk / "lat=48.8566" / "lng=2.3522" / "month=2024-01", {"id": "1"}, {"id": "2"})
    land(uk / f"lat={CITIES[0][0]}" / f"lng={CITIES[0][1]}" / "month=2024-01", {"id": "3"})
    found = extract_uk(spark, str(tmp_path), AS_OF, iter(cities)).collect()
    assert sorted((r["id"], r["location_name"]) for r in found) == [("1", "Paris"), ("2", "Paris")]
    counts = poll(spark, str(tmp_path), AS_OF, "text", str(tmp_path / "topic"), cities=cities).counts
    assert (counts["Paris"], counts["Unknown"], counts["total"]) == (2, 0, 2)


def test_an_unreadable_source_fails_alone(spark, tmp_path):
    chicago(tmp_path, "2024-02-09", {"case_number": "a", "date": "2024-02-09T00:00:00"})
    folder = tmp_path / "source=la" / "day=2024-02-09"
    folder.mkdir(parents=True)
    (folder / "part.json.gz").write_bytes(b"no gzip at all")
    polled = poll(spark, str(tmp_path), AS_OF, "text", str(tmp_path / "topic"))
    assert set(polled.failed) == {"la"} and polled.failed["la"]
    assert (polled.counts["chicago"], polled.counts["la"], polled.counts["total"]) == (1, 0, 1)
    assert len(read_messages(spark, "text", str(tmp_path / "topic")).collect()) == 1


def test_uk_takes_last_month_at_polled_places(spark, tmp_path):
    uk = tmp_path / "source=uk_police"
    lat, lng, name = CITIES[1]
    land(uk / f"lat={lat}" / f"lng={lng}" / "month=2024-01", {"id": "1", "location_name": "sent"}, "junk")
    land(uk / f"lat={lat}" / f"lng={lng}" / "month=2024-02", {"id": "2"})
    land(uk / "lat=0.0000" / "lng=0.0000" / "month=2024-01", {"id": "3"})
    (row,) = extract_uk(spark, str(tmp_path), AS_OF).collect()
    assert (row["id"], row["location_name"], row["month"], row["source"]) == ("1", name, "2024-01", "uk_police")


def test_missing_source_yields_no_rows(spark, tmp_path):
    assert extract_recent(spark, str(tmp_path / "nowhere"), NYC, AS_OF).count() == 0


def test_poll_publishes_and_counts(spark, tmp_path):
    landing, topic = tmp_path / "landing", tmp_path / "topic"
    chicago(landing, "2024-02-09", {"case_number": "a", "date": "2024-02-09T00:00:00", "arrest": "true"})
    lat, lng, name = CITIES[0]
    land(landing / "source=uk_police" / f"lat={lat}" / f"lng={lng}" / "month=2024-01", {"id": "1"}, {"id": "2"})
    polled = poll(spark, str(landing), AS_OF, "text", str(topic))
    assert polled.failed == {}
    counts = polled.counts
    assert (counts["total"], counts["uk_police"], counts["chicago"], counts["nyc"], counts[name]) == (3, 2, 1, 0, 2)
    sent = parse(read_messages(spark, "text", str(topic))).collect()
    assert sorted((r["source"], r["case_number"] or r["id"]) for r in sent) == [
        ("chicago", "a"), ("uk_police", "1"), ("uk_police", "2")
    ]


def test_polls_repeat_with_the_clock(spark, tmp_path):
    landing, topic = tmp_path / "landing", tmp_path / "topic"
    chicago(landing, "2024-02-09", {"case_number": "a", "date": "2024-02-09T00:00:00"})
    hours = iter(range(10**6))
    query = start_polling(
        spark, str(landing), str(tmp_path / "cp"), "2 seconds", "text", str(topic),
        clock=lambda: AS_OF + timedelta(hours=next(hours)),
    )
    try:
        deadline = time.time() + 60
        while next(iter(query.recentProgress[2:]), None) is None and time.time() < deadline:
            time.sleep(0.5)
    finally:
        query.stop()
    sent = parse(read_messages(spark, "text", str(topic))).collect()
    stamps = sorted(r["timestamp"] for r in sent)
    assert {r["case_number"] for r in sent} == {"a"} and len(stamps) >= 2
    assert stamps[:2] == [1707566400, 1707566400 + 3600]
