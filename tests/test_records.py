"""Parsing, validation, quarantine and fingerprints, one case per message."""

import hashlib
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from driftwell.operators.dead_letters import dead_letters
from driftwell.operators.fingerprint import fingerprint
from driftwell.operators.parse import parse_messages, parser_dead_letters
from driftwell.operators.validate import telemetry, validate, validator_dead_letters

GOOD = {
    "event_id": "m-4711",
    "device_id": "pump_12",
    "event_timestamp": "2031-03-09T10:00:00Z",
    "temperature": 18.5,
    "humidity": 41.0,
    "pressure": 1013.25,
    "battery_level": 88.0,
}


def as_of():
    return F.lit("2031-03-09T12:00:00Z").cast("timestamp")




def changed(**fields):
    return json.dumps({**GOOD, **fields}, ensure_ascii=False)


def without(field):
    return json.dumps({k: v for k, v in GOOD.items() if k != field})


def parse(spark, messages):
    rows = [(m if isinstance(m, bytes) else m.encode(), i) for i, m in enumerate(messages)]
    return parse_messages(spark.createDataFrame(rows, "value binary, i int"))


def error_lists(spark, messages):
    checked = validate(parse(spark, messages), as_of())
    found = {r.i: list(r.errors) for r in checked.collect()}
    return [found.get(i) for i in range(len(messages))]


ACCEPTED = ['{"a": 1}', ' {"a": [1, {"b": null}]}\n', "null", "3", '"x"', "[1]", '{"a": 1, "a": 2}', '{"a": "\\u00e9"}']
REFUSED = [
    "", " ", "{", '{"a": 1', '{"a": 1,}', "{'a': 1}", '{"a": 1} x', '{"a": 1}{"b": 2}', "1,2", "1],[2", '{"a": }',
    '﻿{"a": 1}', "NaN", '{"a": 01}', '{"a": 1} // c', '"abc', "plain", '{"a": "x\ty"}', '{"device_id": "d", "temperature": }',
]


def test_exactly_one_json_value(spark):
    routes = {r.i: r.route for r in parse(spark, ACCEPTED + REFUSED).collect()}
    got = [routes[i] for i in range(len(routes))]
    assert got == ["valid"] * len(ACCEPTED) + ["invalid"] * len(REFUSED)


def test_broken_utf8_is_replaced(spark):
    parsed = parse(spark, [b'{"a": "x\xffy"}', b"\xff\xfe"])
    assert {r.i: (r.message, r.route) for r in parsed.collect()} == {
        0: ('{"a": "x�y"}', "valid"),
        1: ("��", "invalid"),
    }


CASES = [
    (json.dumps(GOOD), []),
    *[(without(f), [f"Missing required field: {f}"]) for f in GOOD],
    *[(changed(**{f: None}), [f"Null required field: {f}"]) for f in ("event_id", "device_id", "event_timestamp")],
    *[(changed(**{f: None}), []) for f in ("temperature", "humidity", "pressure", "battery_level")],
    (changed(event_id=5), ["event_id must be a string"]),
    (changed(event_id=True), ["event_id must be a string"]),
    (changed(event_id="  "), ["event_id cannot be empty"]),
    (changed(event_id="x" * 100), []),
    (changed(event_id="x" * 101), ["event_id length is outside allowed range"]),
    (changed(event_id=" " + "é" * 100 + " "), []),
    (changed(device_id=["d"]), ["device_id must be a string"]),
    (changed(device_id=""), ["device_id cannot be empty"]),
    (changed(device_id="d" * 101), ["device_id length is outside allowed range"]),
    (changed(device_id="device 001"), ["device_id contains invalid characters"]),
    (changed(device_id="dé"), ["device_id contains invalid characters"]),
    (changed(device_id=" d_1-A "), []),
    (changed(event_timestamp=1), ["event_timestamp must be a string"]),
    (changed(event_timestamp="soon"), ["event_timestamp is not a valid ISO-8601 timestamp"]),
    (changed(event_timestamp="2026-13-01T00:00:00Z"), ["event_timestamp is not a valid ISO-8601 timestamp"]),
    (changed(event_timestamp="2031-3-9T10:00:00Z"), ["event_timestamp is not a valid ISO-8601 timestamp"]),
    (changed(event_timestamp="2031-03-09T10:00:00"), ["event_timestamp must include timezone"]),
    (changed(event_timestamp="2031-03-09"), ["event_timestamp must include timezone"]),
    (changed(event_timestamp="2031-03-09T12:05:00Z"), []),
    (changed(event_timestamp="2031-03-09T12:05:00.000001Z"), ["event_timestamp is too far in the future"]),
    (changed(event_timestamp="2031-03-09T17:00:00+05:30"), []),
    (changed(temperature=-50, humidity=0, pressure=800, battery_level=0), []),
    (changed(temperature=100, humidity=100, pressure=1200, battery_level=100), []),
    (changed(temperature=150), ["temperature above maximum: 150.0 > 100.0"]),
    (changed(temperature=-50.5), ["temperature below minimum: -50.5 < -50.0"]),
    (changed(humidity="120"), ["humidity above maximum: 120.0 > 100.0"]),
    (changed(pressure="abc"), ["Invalid numeric value for pressure: abc"]),
    (changed(pressure="1000d"), ["Invalid numeric value for pressure: 1000d"]),
    (changed(pressure="NaN"), ["Invalid numeric value for pressure: NaN"]),
    (changed(pressure=[1000]), ["Invalid numeric value for pressure: [1000]"]),
    (changed(temperature=" 18.5 ", battery_level="5e1"), []),
    (changed(temperature=True), []),
    (changed(battery_level=10**30), ["battery_level above maximum: 1e+30 > 100.0"]),
    (changed(battery_level=99999999), ["battery_level above maximum: 99999999.0 > 100.0"]),
    (changed(battery_level=12345678.25), ["battery_level above maximum: 12345678.25 > 100.0"]),
    (changed(humidity=-0.00002), ["humidity below minimum: -2e-05 < 0.0"]),
    (
        changed(battery_level=150, temperature=999, event_id="", device_id="a b", event_timestamp="x"),
        [
            "event_id cannot be empty",
            "device_id contains invalid characters",
            "event_timestamp is not a valid ISO-8601 timestamp",
            "temperature above maximum: 999.0 > 100.0",
            "battery_level above maximum: 150.0 > 100.0",
        ],
    ),
    (json.dumps({"x": {"event_id": "a"}}), [f"Missing required field: {f}" for f in GOOD]),
    ("[1]", ["record must be a JSON object"]),
    ("null", ["record must be a JSON object"]),
    (json.dumps({**GOOD, "extra": {"a": [1]}}), []),
]


def test_every_rule_and_their_order(spark):
    got = error_lists(spark, [message for message, _ in CASES])
    for (message, want), errors in zip(CASES, got, strict=True):
        assert errors == want, message


def test_accepted_records_are_typed(spark):
    messages = [
        changed(temperature="18.5", humidity=None, event_id=" e ", event_timestamp="2031-03-09T10:00:00+05:30"),
        changed(temperature=True, event_timestamp="20310309T100000,5-0130"),
        changed(event_timestamp="2031-03-09 10:00:00.1234567+23:30"),
        changed(event_timestamp="2031-03-09T10Z"),
    ]
    rows = {r.i: r for r in validate(parse(spark, messages), as_of()).collect()}
    at = [r.event_timestamp.replace(tzinfo=timezone.utc) for _, r in sorted(rows.items())]
    assert (rows[0].temperature, rows[0].humidity, rows[0].event_id) == (18.5, None, " e ")
    assert rows[1].temperature == 1.0
    assert at == [
        datetime(2031, 3, 9, 4, 30, tzinfo=timezone.utc),
        datetime(2031, 3, 9, 11, 30, 0, 500000, tzinfo=timezone.utc),
        datetime(2031, 3, 8, 10, 30, 0, 123456, tzinfo=timezone.utc),
        datetime(2031, 3, 9, 10, 0, tzinfo=timezone.utc),
    ]


def test_default_clock_of_the_future_rule(spark):
    early, late = "2020-01-01T00:00:00Z", "2999-01-01T00:00:00Z"
    parsed = parse(spark, [changed(event_timestamp=early), changed(event_timestamp=late)])
    by_now = {r.i: r.route for r in validate(parsed).collect()}
    arrived = parsed.withColumn("arrival_ts", F.lit("2019-12-31T00:00:00Z").cast("timestamp"))
    by_arrival = {r.i: r.route for r in validate(arrived).collect()}
    assert by_now == {0: "valid", 1: "invalid"}
    assert by_arrival == {0: "invalid", 1: "invalid"}


def test_quarantine_messages(spark):
    bad = changed(temperature=999.0, device_id='a"b', note="line\nbreak")
    parsed = parse(spark, ['{"a": ', json.dumps(json.loads(bad), indent=1), json.dumps(GOOD)])
    letters = dead_letters(parser_dead_letters(parsed), validator_dead_letters(validate(parsed, as_of())))
    found = sorted((json.loads(r.value) for r in letters.collect()), key=lambda d: d["error_stage"])
    assert [sorted(d) for d in found] == [["error_message", "error_stage", "raw_message"], ["error_stage", "errors", "record"]]
    assert found[0]["raw_message"] == '{"a": ' and found[0]["error_stage"] == "json_parsing"
    assert isinstance(found[0]["error_message"], str) and found[0]["error_message"]
    assert found[1]["record"] == json.loads(bad)
    assert found[1]["errors"] == ["device_id contains invalid characters", "temperature above maximum: 999.0 > 100.0"]


def expected_hash(**fields):
    payload = {**GOOD, "event_timestamp": "2031-03-09T10:00:00+00:00", **fields}
    text = json.dumps(payload, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode()).hexdigest()


HASHES = [
    ({}, {}),
    ({"event_timestamp": "2031-03-09T15:30:00+05:30", "temperature": "18.50", "humidity": 41}, {}),
    ({"event_id": " m-4711\t"}, {}),
    ({"event_timestamp": "2031-03-09T10:00:00.25Z"}, {"event_timestamp": "2031-03-09T10:00:00.250000+00:00"}),
    ({"pressure": 1000}, {"pressure": 1000.0}),
    ({"humidity": None}, {"humidity": None}),
    ({"humidity": 0.00025, "battery_level": 0.0000125}, {"humidity": 0.00025, "battery_level": 0.0000125}),
    ({"temperature": -0.0005, "humidity": 0, "battery_level": 1e-7}, {"temperature": -0.0005, "humidity": 0.0, "battery_level": 1e-7}),
    ({"event_id": 'q"\\/\b\f\n\r\té😀\u007f\u0001z'}, {"event_id": 'q"\\/\b\f\n\r\té😀\u007f\u0001z'}),
]


def test_fingerprint_is_the_hash_of_canonical_json(spark):
    messages = [json.dumps({**GOOD, **change}) for change, _ in HASHES]
    checked = fingerprint(validate(parse(spark, messages), as_of()))
    got = {r.i: r.payload_hash for r in checked.collect()}
    for i, (_, canonical) in enumerate(HASHES):
        assert got[i] == expected_hash(**canonical), HASHES[i]


@pytest.mark.parametrize("change", [{"temperature": 25.6}, {"device_id": "other"}])
def test_other_content_has_another_fingerprint(spark, change):
    rows = fingerprint(telemetry(validate(parse(spark, [changed(), changed(**change)]), as_of())))
    assert rows.select("payload_hash").distinct().count() == 2
