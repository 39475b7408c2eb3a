"""Scalar functions: timestamps, addresses, progress arithmetic."""

import datetime as dt

from pyspark.sql import functions as F

from evlake.functions import progress_math as pm
from evlake.functions import times, uris

T = dt.datetime(2025, 3, 9, 17, 45, 12)


def test_text_times(spark):
    cases = {
        "2025-03-09T17:45:12Z": T, "2025-03-09T17:45:12z": T, "2025-03-09T19:45:12+02:00": T,
        "2025-03-09T17:45:12": T, "2025-03-09 17:45:12": T, " 2025-03-09T17:45:12Z ": T,
        "2025-03-09T17:45:12.907060504Z": T.replace(microsecond=907060), "2025-03-09T17:45:12.25Z": T.replace(microsecond=250000),
        "2025-03-09T17:45:12.9070605": T.replace(microsecond=907060), "2025-03-09T17:45": T.replace(second=0),
        "2025-03-09T12:45-05:00": T.replace(second=0), "2025-03-09": dt.datetime(2025, 3, 9),
        "2025-03-09T17:45:12+00:00:30": T - dt.timedelta(seconds=30), "": None, "   ": None, "half past nine": None,
        "now": None, "today": None, "2026": None, "2026-08": None, "T17:45": None, "2025-19-70T41:88:77Z": None,
        "2026-02-30": None, "0000-01-01": None, "2025-03-09T17:45:12.Z": None, "1741542312": None, "20250309": None,
        "2025-03-09T17:45:12 Z": None, "2025-03-09Z": None, "epoch": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = df.select("x", times.from_text(F.col("x")).alias("t")).collect()
    assert {r.x: r.t for r in got} == cases


def test_text_time_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2025-03-09T17:45:12",)], "x string")
        seconds = df.select(F.unix_seconds(times.from_text(F.col("x")))).head()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seconds == int(T.replace(tzinfo=dt.timezone.utc).timestamp())


def test_epoch_times(spark):
    values = [1741542312.0, 1741542312000.0, 0.0, -1.0, 1.5, 1e11, float("nan"), float("inf"), 1e300, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(F.unix_micros(times.from_epoch(F.col("x")))).collect()]
    assert got == [1741542312000000, 1741542312000000, 0, -1000000, 1500000, 10**17, None, None, None, None]


def test_addresses(spark):
    cases = {"s3://b/a/k": ("b", "a/k"), "s3a://b//k": ("b", "k"), " s3://b ": ("b", ""), "s3://": None,
             "s3:///k": None, "http://b/k": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = df.select("x", uris.parse_uri(F.col("x")).alias("u")).collect()
    assert {r.x: tuple(r.u) if r.u else None for r in got} == cases


def test_redaction(spark):
    cases = {"https://u:p@h/x": "https://u:<redacted>@h/x", "https://u@h": "https://u@h", "https://h:8181/x": "https://h:8181/x",
             "u:p@h": "u:p@h", "s3://b/k": "s3://b/k"}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    assert {r[0]: r[1] for r in df.select("x", uris.redact_uri(F.col("x"))).collect()} == cases
    names = ["s3.Secret-key", "PASSWORD", "token", "my.credential", "s3.access-key-id", "access_key_id", "uri", "region"]
    df = spark.createDataFrame([({n: "v" for n in names},)], "m map<string,string>")
    safe = df.select(uris.redact_properties(F.col("m"))).head()[0]
    assert [n for n in names if safe[n] == "v"] == ["uri", "region"]


def test_scale_and_gaps(spark):
    cases = {37.0: 50, 0.0: 10, 50.0: 50, 50.5: 100, -2.0: 10, 4999.0: 5000, 1e6: 1000000, 2e6: 2100001, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "x double")
    assert {r[0]: r[1] for r in df.select("x", pm.axis_top(F.col("x"))).collect()} == cases
    gaps = spark.createDataFrame([(5, 3), (3, 5), (None, 3), (3, None)], "a long, b long")
    assert [r[0] for r in gaps.select(pm.floored_gap(F.col("a"), F.col("b"))).collect()] == [2, 0, None, None]
    files = spark.createDataFrame([(91, 7), (4, 0), (None, 3)], "a long, b long")
    assert [r[0] for r in files.select(pm.mean_file_rows(F.col("a"), F.col("b"))).collect()] == [13.0, None, None]
