"""Documents that are odd, dirty or no documents at all."""

import json
from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywatch.functions.incidents import nested_value
from tallywatch.operators.normalize import UNIFIED_COLUMNS, quarantine, routed, unify, with_event_time
from tallywatch.schema import ENVELOPE, NARROW_ENVELOPE, SOURCES
from tallywatch.sinks.messages import to_messages
from tallywatch.sources.messages import parse, parse_narrow


def messages(spark, *values):
    texts = [(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values]
    return spark.createDataFrame(texts, "value string")


def parse_one(spark, value):
    return parse(messages(spark, value)).first()


def test_envelope_has_all_fields():
    assert len(ENVELOPE) == 64
    assert len(NARROW_ENVELOPE) == 10
    kinds = [f.dataType.simpleString() for f in ENVELOPE]
    assert kinds.count("string") == 61 and kinds.count("map<string,string>") == 2


def test_nested_objects_stay_text_and_numbers_become_text(spark):
    record = {
        "source": "uk_police", "id": 123, "outcome_status": None,
        "location": {"latitude": "51.5", "street": {"id": 1, "name": "High St"}},
    }
    row = parse_one(spark, record)
    assert row["id"] == "123"
    assert row["location"] == {"latitude": "51.5", "street": '{"id":1,"name":"High St"}'}
    assert row["outcome_status"] is None
    street = parse(messages(spark, record)).select(nested_value("location", "street", "$.name"))
    assert street.first()[0] == "High St"


def test_booleans_become_text(spark):
    assert parse_one(spark, {"source": "chicago", "arrest": True})["arrest"] == "true"


@pytest.mark.parametrize("stamp", ["1700000000", 1.5, "noon"])
def test_wrong_type_loses_only_its_field(spark, stamp):
    row = parse_one(spark, {"source": "la", "timestamp": stamp, "area_name": "Central"})
    assert (row["source"], row["timestamp"], row["area_name"]) == ("la", None, "Central")


def test_text_for_a_map_loses_only_its_field(spark):
    row = parse_one(spark, {"source": "chicago", "location": "oops", "district": "1"})
    assert (row["location"], row["district"]) == (None, "1")


@pytest.mark.parametrize("value", ["not json", "[]", None, ""])
@pytest.mark.parametrize("parser", [parse, parse_narrow])
def test_unreadable_document_is_one_row_of_nulls(spark, parser, value):
    (row,) = parser(messages(spark, value)).collect()
    assert set(row.asDict().values()) == {None}


def test_narrow_parse_of_cut_documents(spark):
    """A document cut off inside a nested value is unreadable to the narrow parse, while the full one may keep the
    fields before it. Everything else parses alike."""
    whole = json.dumps(
        {"source": "chicago", "timestamp": 1700000000, "location": {"latitude": "1", "street": {"id": 1}},
         "vict_age": [1, {"a": "b"}], "district": "7", "unheard": None, "primary_type": "T\u00e9 \"x\""}
    )
    nested = {i for name, end in (("location", "}}"), ("vict_age", "}]"))
              for i in range(whole.index(name), whole.index(end, whole.index(name)) + 2)}
    values = {i: whole[:i] for i in range(len(whole) + 1)}
    values |= {-1: whole + whole, -2: whole + "x", -3: whole.replace("1700000000", "1e400"),
               -4: whole.replace('"7"', "[7]"), -5: whole.replace('"7"', '{"a": 1}')}
    frame = spark.createDataFrame(list(values.items()), "i int, value string")
    names = NARROW_ENVELOPE.fieldNames()
    full, narrow = (F.from_json("value", schema) for schema in (ENVELOPE, NARROW_ENVELOPE))
    for row in frame.select("i", full.alias("full"), narrow.alias("narrow")).collect():
        from_full = [row["full"] and row["full"][n] for n in names]
        from_narrow = [row["narrow"] and row["narrow"][n] for n in names]
        if from_full != from_narrow:
            assert row["i"] in nested and set(from_narrow) == {None}


def test_binary_values(spark):
    frame = spark.createDataFrame([(bytearray(b'{"source":"la"}'),)], "value binary")
    assert parse_narrow(frame).first()["source"] == "la"


def test_seconds_after_2038_and_unusable_stamps(spark):
    stamps = [4_000_000_000, -1, 5_000_000_000, 1_700_000_000_000, 9_223_372_036_854_775_807, -9_223_372_036_854_775_808]
    found = unify(parse(messages(spark, *({"source": "la", "timestamp": t} for t in stamps))))
    times = {r["timestamp"]: r["event_time"] for r in found.collect()}
    assert times[4_000_000_000].year == 2096 and times[-1].year == 1969
    assert [times[t] for t in stamps[2:]] == [None] * 4


def test_routing_and_quarantine_split_the_input(spark):
    envelopes = parse(
        messages(spark, {"source": "la", "id": "1", "timestamp": 5}, {"source": "paris", "id": "2", "timestamp": 5}, {"id": "3"},
                 "x", None, {"source": "la", "id": "4"}, {"source": "la", "id": "5", "timestamp": 10**12})
    )
    assert [r["id"] for r in routed(envelopes).collect()] == ["1", "4", "5"]
    assert sorted((str(r["id"]), r["reason"]) for r in quarantine(envelopes).collect()) == [
        ("2", "source"), ("3", "source"), ("4", "event time"), ("5", "event time"), ("None", "source"), ("None", "source")]


def unify_by_branch(envelopes):
    """A union of one branch per source."""
    timed = with_event_time(envelopes)
    branches = [
        timed.filter(F.col("source") == s.name).withColumns(
            {"crime_type": F.col(s.type_field), "location_name": F.col(s.place_field)}
        ).select(*UNIFIED_COLUMNS)
        for s in SOURCES
    ]
    return reduce(lambda a, b: a.unionByName(b), branches)


texts = st.none() | st.text(alphabet="abz{}\"\\'\n\té ", max_size=6)
records = st.fixed_dictionaries(
    {
        "source": st.sampled_from(["uk_police", "chicago", "nyc", "la", "other", None]),
        "timestamp": st.none() | st.integers(-(2**31), 2**40),
        **{field: texts for s in SOURCES for field in (s.type_field, s.place_field)},
    }
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=st.lists(records, min_size=1, max_size=15))
def test_one_pass_equals_union_of_branches(spark, rows, batch):
    frame = spark.createDataFrame([tuple(r[f.name] for f in NARROW_ENVELOPE) for r in batch], NARROW_ENVELOPE)
    assert rows(unify(frame)) == rows(unify_by_branch(frame))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=st.lists(records, min_size=1, max_size=15))
def test_parsing_undoes_writing(spark, rows, batch):
    frame = spark.createDataFrame([tuple(r[f.name] for f in NARROW_ENVELOPE) for r in batch], NARROW_ENVELOPE)
    assert rows(parse_narrow(to_messages(frame))) == rows(frame)
