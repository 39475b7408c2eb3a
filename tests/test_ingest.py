"""The streaming job: acknowledgement, replay, retry, sinks, checks."""

import json
import time

import pytest
from pyspark.sql import functions as F

from evlake.operators.copies import copy_counts, drop_copies, drop_copies_streaming, duplicates
from evlake.operators.decode import decode
from evlake.operators.flatten import flatten
from evlake.sources.topic import FileTopic, next_offsets
from evlake.streaming.ingest import Ingest, Retry, Sink, console_sink, quarantine_sink, shown_payloads
from evlake.streaming.tables import ParquetTable

EVENT = json.dumps({"Records": [{"eventName": "n"}]})


@pytest.fixture
def lake(spark, tmp_path):
    """Topic, table and a job factory in a folder of their own."""

    class Lake:
        topic = FileTopic(str(tmp_path / "topic"))
        table = ParquetTable(spark, str(tmp_path / "wh"), "ns", "events")
        path = tmp_path

        def job(self, checkpoint="cp", topic=None, **options):
            when = F.col("timestamp")
            return Ingest(topic or self.topic, self.table, str(tmp_path / checkpoint), ingest_time=when, **options)

    return Lake()


def keys(table):
    return sorted((r.kafka_partition, r.kafka_offset) for r in table.read().collect())


def fail_times(n, error=OSError("down")):
    left = [n]

    def fail(*args):
        if left[0]:
            left[0] -= 1
            raise error

    return fail


def test_resume_and_new_checkpoint(spark, lake, topic_of):
    every = topic_of([EVENT] * 8, partitions=2)
    lake.topic.publish(every.where("offset < 2"))
    lake.job().drain(spark)
    lake.topic.publish(every.where("offset >= 2"))
    lake.job().drain(spark)
    assert keys(lake.table) == [(p, o) for p in (0, 1) for o in range(4)]
    lake.job().drain(spark)
    assert lake.table.history().count() == 2
    # A new checkpoint reads everything again and overwrites nothing.
    lake.job("other").drain(spark)
    rows = lake.table.read()
    assert rows.count() == 16 and {r.copies for r in copy_counts(rows).collect()} == {2}
    assert duplicates(rows).count() == 8 and drop_copies(rows).count() == 8


def test_start_at_latest(spark, lake, topic_of):
    every = topic_of([EVENT] * 4)
    lake.topic.publish(every.where("offset < 3"))
    latest = FileTopic(lake.topic.path, start=next_offsets(lake.topic.batch(spark)))
    lake.job(topic=latest).drain(spark)
    lake.topic.publish(every.where("offset >= 3"))
    lake.job(topic=latest).drain(spark)
    assert keys(lake.table) == [(0, 3)]


@pytest.mark.parametrize("replace,copies", [(True, 1), (False, 2)])
def test_crash_before_acknowledgement(spark, lake, topic_of, replace, copies):
    lake.topic.publish(topic_of([EVENT] * 3))
    job = lake.job(before_ack=fail_times(1), replace_retried=replace)
    with pytest.raises(Exception):
        job.drain(spark)
    job.drain(spark)
    assert {r.copies for r in copy_counts(lake.table.read()).collect()} == {copies}


def test_failed_write_is_not_acknowledged(spark, lake, topic_of):
    lake.topic.publish(topic_of([EVENT] * 3))
    lake.table.open()
    append, waits = lake.table.append, []
    lake.table.append = fail_times(99)
    with pytest.raises(Exception):
        lake.job(retry=Retry(attempts=3, base=5.0, sleep=waits.append)).drain(spark)
    assert waits == [5.0, 10.0] and lake.table.read().count() == 0
    lake.table.append = append
    lake.job().drain(spark)
    assert keys(lake.table) == [(0, 0), (0, 1), (0, 2)]


def test_backoff():
    retry = Retry(base=5.0)
    assert [retry.wait_after(n) for n in range(1, 7)] == [5, 10, 20, 40, 60, 60]
    done = []
    fail = fail_times(2)
    Retry(attempts=3, sleep=done.append).run(fail, "write")
    assert done == [5.0, 10.0]
    with pytest.raises(OSError):
        Retry(attempts=2, sleep=done.append).run(fail_times(2), "write")


def test_sinks_are_isolated(spark, lake, topic_of):
    lake.topic.publish(topic_of([EVENT, "not json", None]))
    shown, seen = [], []
    sinks = [
        Sink("broken", fail_times(9)),
        console_sink(show=shown.append),
        quarantine_sink(str(lake.path / "bad")),
        Sink("count", lambda rows, decoded, batch: seen.append((batch, rows.count()))),
    ]
    lake.job(sinks=sinks).drain(spark)
    assert lake.table.read().count() == 1 and seen == [(0, 1)]
    assert shown == [json.dumps(json.loads(EVENT), indent=2) + "\n"]
    assert spark.read.parquet(str(lake.path / "bad")).count() == 2


def test_required_sink_stops_the_query(spark, lake, topic_of):
    lake.topic.publish(topic_of([EVENT]))
    with pytest.raises(Exception):
        lake.job(sinks=[Sink("vital", fail_times(9), required=True)]).drain(spark)
    lake.job(sinks=[Sink("vital", lambda *a: None, required=True)]).drain(spark)
    assert lake.table.read().count() == 1


def test_startup_opens_all_or_none(spark, lake, topic_of):
    lake.topic.publish(topic_of([EVENT]))
    closed = []
    sinks = [
        Sink("a", lambda *a: None, check=lambda: None, close=lambda: closed.append("a")),
        Sink("b", lambda *a: None, check=lambda: None, close=lambda: closed.append("b")),
        Sink("c", lambda *a: None, check=fail_times(9)),
    ]
    with pytest.raises(OSError):
        lake.job(sinks=sinks).start(spark)
    assert closed == ["b", "a"] and lake.table.read().count() == 0


def test_check_consumes_nothing(spark, lake, topic_of):
    lake.topic.publish(topic_of([EVENT]))
    assert lake.job().check() == {"missing": [], "extra": []}
    assert lake.table.exists() and lake.table.read().count() == 0
    lake.job().drain(spark)
    assert lake.table.read().count() == 1


def test_no_table_and_none_to_be_created(spark, lake, topic_of):
    lake.topic.publish(topic_of([EVENT]))
    with pytest.raises(RuntimeError):
        lake.job(create_table=False).start(spark)


def test_interval_trigger(spark, lake, topic_of):
    every = topic_of([EVENT] * 4)
    lake.topic.publish(every.where("offset < 2"))
    query = lake.job().start(spark, every=0.5)
    query.processAllAvailable()
    lake.topic.publish(every.where("offset >= 2"))
    query.processAllAvailable()
    time.sleep(2)  # idle intervals write nothing
    query.stop()
    assert [h.added for h in lake.table.history().collect()] == [2, 2]


def test_streaming_dedup(spark, lake, topic_of):
    lake.topic.publish(topic_of([EVENT] * 3))
    lake.topic.publish(topic_of([EVENT] * 3))
    rows = flatten(decode(lake.topic.stream(spark)), F.col("timestamp"))
    out = str(lake.path / "once")
    writer = drop_copies_streaming(rows, "1 hour").writeStream.format("parquet").trigger(availableNow=True)
    writer.option("checkpointLocation", str(lake.path / "cp2")).start(out).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_console_in_files_passes_no_payload_through_the_driver(spark, lake, topic_of, tmp_path, monkeypatch):
    lake.topic.publish(topic_of([EVENT, "not json", '{"a": "x\\n\\ny"}', '""']))
    out = str(tmp_path / "shown")
    monkeypatch.setattr(spark.range(1).__class__, "toLocalIterator", lambda *args, **more: pytest.fail("through the driver"))
    lake.job(sinks=[console_sink(path=out)]).drain(spark)
    want = [json.dumps(json.loads(t), indent=2) for t in (EVENT, '{"a": "x\\n\\ny"}', '""')]
    assert sorted(r.value for r in shown_payloads(spark, out).collect()) == sorted(want)
