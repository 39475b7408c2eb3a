"""Payload shapes and the rows they must give."""

import datetime as dt
import json

from pyspark.sql import functions as F

from evlake.operators.decode import decode, quarantine
from evlake.operators.flatten import flatten
from evlake.schema import EVENTS

NOTHING = (None,) * 7


def obj(**fields):
    return {"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "k", **fields}}}]}


FULL = {
    "eventName": "s3:ObjectCreated:Put", "eventTime": "2025-03-09T17:45:12.250Z", "eventSource": "aws:s3",
    "s3": {"bucket": {"name": "data", "arn": "arn:aws:s3:::data"}, "object": {"key": "a.txt", "size": 7, "eTag": "e"}},
}
WHEN = dt.datetime(2025, 3, 9, 17, 45, 12, 250000)
FULL_ROW = ("s3:ObjectCreated:Put", WHEN, "aws:s3", "data", "a.txt", 7, "e")
TEST = {"Service": "Amazon S3", "Event": " s3:TestEvent ", "Time": "2025-03-09T17:45:12.250Z", "Bucket": "data"}


def only(**values):
    names = ["event_name", "event_time", "event_source", "bucket", "object_key", "object_size", "object_etag"]
    return tuple(values.get(n) for n in names)


# Payload, expected rows as (name, time, source, bucket, key, size, etag).
CASES = [
    ({"Records": [FULL]}, [FULL_ROW]),
    ({"records": [FULL]}, [FULL_ROW]),
    ({"Records": "x", "records": [FULL]}, [FULL_ROW]),
    ({"Records": [FULL], "records": []}, [FULL_ROW]),
    ({"Records": [], "records": [FULL]}, [NOTHING]),
    (FULL, [FULL_ROW]),
    ({"Records": [FULL, {}, FULL]}, [FULL_ROW, NOTHING, FULL_ROW]),
    ({"Records": []}, [NOTHING]),
    ({"Records": [], **FULL}, [NOTHING]),
    ({"Records": "later"}, [NOTHING]),
    ({"Records": None, **FULL}, [FULL_ROW]),
    ({"Records": ["loose end", -3, None, [[]]]}, [NOTHING] * 4),
    ([0.5, []], [NOTHING]), ("words", [NOTHING]), (-3, [NOTHING]), (True, [NOTHING]), (None, [NOTHING]),
    ([FULL], [NOTHING]),
    ({"lamp": ["on"]}, [NOTHING]),
    # connectivity test
    (TEST, [only(event_name="s3:TestEvent", event_time=WHEN, event_source="Amazon S3", bucket="data")]),
    ({**TEST, "Bucket": " "}, [only(event_name="s3:TestEvent", event_time=WHEN, event_source="Amazon S3")]),
    ({**TEST, "Bucket": 5, "Time": None, "eventName": "x"}, [only(event_name="s3:TestEvent", event_source="Amazon S3")]),
    ({**TEST, "Records": [{"s3": {}}]}, [NOTHING]),
    ({**TEST, "records": None}, [NOTHING]),
    ({**TEST, "Service": "another sender"}, [NOTHING]),
    ({**TEST, "Service": ["s3"]}, [NOTHING]),
    ({**TEST, "Event": "  "}, [NOTHING]),
    ({"Event": "s3:TestEvent"}, [NOTHING]),
    # wrong types
    ({"Records": [{"s3": "x", "S3": FULL["s3"]}]}, [NOTHING]),
    ({"Records": [{"s3": {}, "S3": FULL["s3"]}]}, [only(bucket="data", object_key="a.txt", object_size=7, object_etag="e")]),
    ({"Records": [{"s3": {"bucket": "x", "object": ["k"]}}]}, [NOTHING]),
    ({"Records": [{"s3": {"bucket": False, "Bucket": {"Name": "n"}}}]}, [only(bucket="n")]),
    # text
    ({"Records": [{"eventName": "  ", "EventName": "\u00a0x y\u2003"}]}, [only(event_name="x y")]),
    ({"Records": [{"eventName": 12, "eventSource": 1.5}]}, [only(event_name="12", event_source="1.5")]),
    ({"Records": [{"eventName": True, "eventType": 2.0}]}, [only(event_name="2.0")]),
    ({"Records": [{"eventName": 2**70}]}, [only(event_name=str(2**70))]),
    ({"Records": [{"eventTime": 1741542312}]}, [NOTHING]),
    ({"Records": [{"eventTime": "half past nine", "eventName": "n"}]}, [only(event_name="n")]),
    # sizes
    *[(obj(size=v), [only(bucket="b", object_key="k", object_size=e)]) for v, e in [
        (731, 731), ("\t731 ", 731), ("tiny", None), (True, None), (2**70, None), (2**63 - 1, 2**63 - 1),
        (-(2**63), -(2**63)), (2**63, None), (1.5, None), (3.0, 3), (1e3, 1000), (1e19, None), ("1_000", 1000),
        ("1__0", None), ("+7", 7), ("", None), ([1], None), ({}, None), (None, None), ("7.0", None), (1e-9, None),
    ]],
    (obj(size="x", objectSize=None, Size=5), [only(bucket="b", object_key="k", object_size=5)]),
    # keys
    *[(obj(key=v), [only(bucket="b", object_key=e)]) for v, e in [
        ("maps/east+wing%20v2.svg", "maps/east wing v2.svg"), ("100%", "100%"), ("%zz%41", "%zzA"), ("a%2Bb+c", "a+b c"),
        ("%C3%A9", "é"), ("%E2%82", "\ufffd"),
    ]],
]


def test_shapes(spark, topic_of):
    payloads = [json.dumps(p) for p, _ in CASES]
    rows = flatten(decode(topic_of(payloads)), F.col("timestamp")).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.kafka_offset, r.record_index)):
        got.setdefault(r.kafka_offset, []).append(r)
    for i, (payload, expected) in enumerate(CASES):
        found = got[i]
        assert [tuple(r)[5:12] for r in found] == expected, payload
        assert [r.record_index for r in found] == list(range(len(expected)))
        assert {r.raw_event for r in found} == {payloads[i]}
        assert {r.kafka_topic for r in found} == {"t"}


def test_schema_is_the_tables(spark, topic_of):
    rows = flatten(decode(topic_of([json.dumps(FULL)])))
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in EVENTS]


def test_one_ingest_time_per_batch(spark, topic_of):
    rows = flatten(decode(topic_of([json.dumps({"Records": [FULL, FULL]}), json.dumps(FULL)])))
    assert rows.select("ingest_time").distinct().count() == 1


def test_numeric_event_time_on_request(spark, topic_of):
    payload = json.dumps({"Records": [{"eventTime": 1741542312}, {"eventTime": 1741542312000}]})
    rows = flatten(decode(topic_of([payload])), epoch_event_time=True)
    assert {r.event_time for r in rows.collect()} == {dt.datetime(2025, 3, 9, 17, 45, 12)}


def test_undecodable_messages(spark, topic_of):
    long = "x" * 900
    bad = [None, b"", b"  ", b"plain words", b'{"a":1} {"a":2}', b"1,2", b"1],[2", b"'a'", b"[1,]", b"{\"a\":01}",
           b'\xef\xbb\xbf{"a":1}', long.encode(), b'{"a":NaN}']
    good = [b' {"a":1}\n', b'{"a":"\xff"}', b'{"a":1,"a":2}', b"null", b'"x"']
    decoded = decode(topic_of(bad + good))
    kept = quarantine(decoded).orderBy("offset").collect()
    assert [r.offset for r in kept] == list(range(len(bad)))
    assert kept[0].reason == "no payload" and {r.reason for r in kept[1:]} == {"not JSON"}
    assert kept[11].preview == "x" * 500
    rows = flatten(decoded).orderBy("kafka_offset").collect()
    assert [r.kafka_offset for r in rows] == list(range(len(bad), len(bad) + len(good)))
    assert rows[1].raw_event == '{"a":"\ufffd"}'
