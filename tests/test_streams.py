"""Bounds, copies, progress, stopping and sinks of a running job."""

import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from evlake.operators.copies import copy_counts, drop_copies, in_ranges, new_rows, offset_ranges
from evlake.operators.decode import decode
from evlake.operators.flatten import flatten
from evlake.plans.reconcile import added_marks, differing_stretches, key_balance, range_marks, survival_by_stretch
from evlake.sources.listing import list_prefixes, sub_prefixes
from evlake.sources.topic import FileTopic, KafkaTopic
from evlake.streaming.content_sink import content_sink, loaded_keys, loaded_records
from evlake.streaming.ingest import Ingest, Sink, stop_mark
from evlake.streaming.progress_log import PROGRESS, latest_progress, live_lag, live_marks, progress_rows, read_progress
from evlake.streaming.sample_stream import kept_history, live_rates
from evlake.streaming.tables import ParquetTable
from evlake.streaming.task_sink import JsonFolder, JsonFolderWriter, Staged, whole_files

EVENT = json.dumps({"Records": [{"eventName": "n"}]})


def rows_of(messages):
    return flatten(decode(messages), F.col("timestamp"))


@pytest.fixture
def lake(spark, tmp_path):
    class Lake:
        topic = FileTopic(str(tmp_path / "topic"), max_files=1)
        table = ParquetTable(spark, str(tmp_path / "wh"), "ns", "events").open()
        path = tmp_path

        def job(self, checkpoint="cp", topic=None, **options):
            return Ingest(topic or self.topic, self.table, str(tmp_path / checkpoint), ingest_time=F.col("timestamp"), **options)

    return Lake()


def keys(table):
    return sorted((r.kafka_partition, r.kafka_offset) for r in table.read().collect())


def test_kafka_rows_or_time():
    options = KafkaTopic("n", "h", min_messages=100).read_options(True)
    assert (options["minOffsetsPerTrigger"], options["maxTriggerDelay"]) == ("100", "10 seconds")
    assert KafkaTopic("n", "h", min_messages=5, max_delay="2 minutes").read_options(True)["maxTriggerDelay"] == "2 minutes"
    assert "minOffsetsPerTrigger" not in KafkaTopic("n", "h").read_options(True)
    assert "minOffsetsPerTrigger" not in KafkaTopic("n", "h", min_messages=5).read_options(False)


def test_bytes_bound_a_batch(spark, lake, topic_of):
    for n in range(3):
        lake.topic.publish(topic_of([EVENT] * 6).where(f"offset % 3 = {n}").coalesce(1))
    # Less than a file: one at a time.
    lake.job(topic=FileTopic(lake.topic.path, max_bytes=1)).drain(spark)
    assert [r.added for r in lake.table.history().collect()] == [2, 2, 2]
    lake.job("other", topic=FileTopic(lake.topic.path, max_bytes=10**9)).drain(spark)
    assert [r.added for r in lake.table.history().collect()] == [2, 2, 2, 6]


def test_stop_finishes_the_batch_at_hand(spark, lake, topic_of):
    for n in range(4):
        lake.topic.publish(topic_of([EVENT] * 8).where(f"offset % 4 = {n}").coalesce(1))
    mark = str(lake.path / "stop")
    ask = Sink("ask", lambda rows, decoded, batch: batch == 1 and os.makedirs(mark), required=True)
    job = lake.job(sinks=[ask])
    ended = job.run(spark, stop_mark(spark, mark), every=0.1, poll=0.05)
    assert (ended.batches, ended.left) == (2, True) and len(keys(lake.table)) == 4
    assert not spark.streams.active
    os.rmdir(mark)
    # The rest, and then nothing is left: an idle query is stopped too.
    again = lake.job()
    ended = again.run(spark, lambda: again._finished == 2, every=0.1, poll=0.05)
    assert (ended.batches, ended.left) == (2, False)
    assert keys(lake.table) == [(0, o) for o in range(8)]


def test_a_failure_is_no_stop(spark, lake, topic_of):
    lake.topic.publish(topic_of([EVENT]))

    def broken(rows, decoded, batch):
        raise OSError("unreachable")

    job = lake.job(sinks=[Sink("broken", broken, required=True)])
    job.retry = type(job.retry)(attempts=1)
    with pytest.raises(Exception, match="unreachable"):
        job.run(spark, lambda: False, every=0.1, poll=0.05)


def test_only_new_rows_are_stored(spark, lake, topic_of):
    every = topic_of([EVENT] * 20, partitions=2)
    lake.topic.publish(every.where("offset < 5").unionAll(every.where("offset < 3")))
    lake.job(once=True).drain(spark)
    assert keys(lake.table) == [(p, o) for p in (0, 1) for o in range(5)]
    lake.topic.publish(every)
    lake.job("from the start", once=True).drain(spark)
    assert {r.copies for r in copy_counts(lake.table.read()).collect()} == {1} and lake.table.read().count() == 20
    before = lake.table.history().count()
    lake.job("again", once=True).drain(spark)
    assert lake.table.read().count() == 20 and lake.table.history().count() == before


def test_new_rows_read_the_ranges_only(spark, lake, topic_of):
    every = rows_of(topic_of([EVENT] * 40, partitions=2))
    for start in (0, 10):
        lake.table.append(every.where(F.col("kafka_offset").between(start, start + 9)), "load", start)
    batch = every.where("kafka_offset between 12 and 14")
    ranges = offset_ranges(batch)
    assert sorted((r.kafka_partition, r.low, r.high) for r in ranges) == [(0, 12, 14), (1, 12, 14)]
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = lake.table.read().where(in_ranges(ranges))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(kafka_offset,12)" in plan and "LessThanOrEqual(kafka_offset,14)" in plan
    assert new_rows(batch, lake.table.read()).count() == 0
    # Rows without coordinates have no key and are kept, each of them.
    bare = batch.withColumn("kafka_offset", F.lit(None).cast("long"))
    assert new_rows(batch.unionAll(bare), lake.table.read()).count() == bare.count()
    assert new_rows(batch.limit(0), lake.table.read()).count() == 0


def test_copies_take_one_shuffle(spark, topic_of):
    rows = rows_of(topic_of([EVENT] * 10))
    plan = drop_copies(rows.unionAll(rows))._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Join" not in plan
    assert drop_copies(rows.unionAll(rows)).count() == 10


def test_copies_kept_out_by_the_stream(spark, lake, topic_of):
    every = topic_of([EVENT] * 6).withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("offset") * 3600))
    for part in ("offset < 3", "offset between 1 and 4", "offset = 5", "offset < 2"):
        lake.topic.publish(every.where(part).coalesce(1))
    job = lake.job(within="3 hours", progress=str(lake.path / "progress"))
    job.drain(spark)
    assert job.progress_log.wait()
    assert keys(lake.table) == [(0, o) for o in range(6)]
    told = read_progress(spark, job.progress)
    late = {r.batch_id: r.dropped_late for r in told.collect()}
    # 0 and 1 come again after the watermark has passed them.
    assert late == {0: 0, 1: 0, 2: 0, 3: 2}
    assert sum(r.dropped_copies for r in told.collect()) == 2


REPORT = {
    "id": "q", "runId": "r", "batchId": 3, "timestamp": "2024-01-05T00:00:00.000Z", "numInputRows": 12,
    "stateOperators": [{"numRowsDroppedByWatermark": 2, "customMetrics": {"numDroppedDuplicateRows": 5}}],
    "sources": [{
        "description": "KafkaV2[Subscribe[t]]", "numInputRows": 12, "startOffset": {"t": {"0": 5, "1": 7}},
        "endOffset": {"t": {"0": 9, "1": 15}}, "latestOffset": '{"t": {"0": 9, "1": 40, "2": 3}}',
    }],
}


def test_reports_become_rows(spark):
    later = {**REPORT, "batchId": 4, "sources": [{**REPORT["sources"][0], "endOffset": {"t": {"0": 9, "1": 38}}}]}
    rows = [json.dumps(r) for report in (REPORT, later) for r in progress_rows(report)]
    told = spark.createDataFrame([(r,) for r in rows], "value string").select(F.from_json("value", PROGRESS).alias("r")).select("r.*")
    first = {r.partition: r for r in told.where("batch_id = 3").collect()}
    assert (first[1].start_offset, first[1].end_offset, first[1].latest_offset) == (7, 15, 40)
    assert first[2].end_offset is None and sum(r.input_rows for r in first.values()) == 12
    assert {r.dropped_late for r in first.values()} == {2} and {r.dropped_copies for r in first.values()} == {5}
    assert {r.partition: r.lag for r in live_marks(told).where("partition < 2").collect()} == {0: 0, 1: 2}
    total = live_lag(told).head()
    assert (total.topic, total.end_offset, total.committed, total.partitions) == ("t", 52, 47, 3)
    assert latest_progress(told).agg(F.sum("rows_in_all")).head()[0] == 24


def test_reports_without_partitions():
    file = {**REPORT, "sources": [{"description": "FileStreamSource[x]", "numInputRows": 4, "startOffset": None,
                                   "endOffset": {"logOffset": 2}, "latestOffset": None}]}
    (row,) = progress_rows(file)
    assert (row["topic"], row["end_offset"], row["input_rows"]) == (None, 2, 4)
    odd = {**REPORT, "sources": [{"description": "x", "numInputRows": 1, "startOffset": "?", "endOffset": None}]}
    assert progress_rows(odd)[0]["end_offset"] is None and progress_rows({**REPORT, "sources": []}) == []


def test_only_the_own_query_is_logged(spark, lake, topic_of):
    lake.topic.publish(topic_of([EVENT] * 3).coalesce(1))
    path = str(lake.path / "progress")
    jobs = [lake.job(progress=path), lake.job("other")]
    for job in jobs:
        job.drain(spark)
    assert jobs[0].progress_log.wait()
    assert [(r.batch_id, r.input_rows) for r in read_progress(spark, path).collect()] == [(0, 3)]


def test_rates_over_a_restart(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    shape = "pipeline string, t double, n long"
    day = 86_400.0
    parts = [[("a", 1.0, 10), ("a", 3.0, 20), ("b", 1.0, None)], [("a", 4.0, 26), ("b", 2.0, 5), ("a", 2.0, 99)], [("b", 4.0, 6)]]

    def run(part):
        spark.createDataFrame(part, shape).coalesce(1).write.mode("append").parquet(source)
        stream = live_rates(spark.readStream.schema(shape).parquet(source), ["n"], keep=2)
        query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        if not query.awaitTermination(120):
            query.stop()
            raise AssertionError("the query does not end")

    for part in parts:
        run(part)
    got = {(r.pipeline, r.t): r.n_rate for r in spark.read.parquet(out).collect()}
    # The sample of time 2 came after that of time 3.
    assert got == {("a", 1.0): None, ("a", 3.0): 5.0, ("b", 1.0): None, ("a", 4.0): 6.0, ("a", 2.0): None, ("b", 2.0): None, ("b", 4.0): 0.5}
    kept = sorted(tuple(r) for r in kept_history(spark, checkpoint).collect())
    assert kept == [("a", 3.0, 20), ("a", 4.0, 26), ("b", 2.0, 5), ("b", 4.0, 6)]
    # A pipeline silent for long is forgotten; the newest stays.
    run([("c", 40 * day, 7)])
    assert [tuple(r) for r in kept_history(spark, checkpoint).collect()] == [("c", 40 * day, 7)]


def test_listing_in_tasks(spark, tmp_path):
    for name in ("a/1.json", "a/deep/er/2.json", "a/x.txt", "b/3 4+%.json", "c/none.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x" * len(name))
    prefixes = sub_prefixes(spark, str(tmp_path))
    assert len(prefixes) == 3
    listed = list_prefixes(spark, [*prefixes, str(tmp_path / "missing")], ".json")
    assert listed.rdd.getNumPartitions() == 4
    found = {r.path.rpartition(str(tmp_path) + "/")[2]: (r.length, r.modificationTime) for r in listed.collect()}
    assert {k: v[0] for k, v in found.items()} == {n: len(n) for n in ("a/1.json", "a/deep/er/2.json", "b/3 4+%.json")}
    age = abs(pd.Timestamp(found["a/1.json"][1]).timestamp() - os.path.getmtime(tmp_path / "a/1.json"))
    assert age % 3600 < 1 or age % 3600 > 3599
    assert list_prefixes(spark, [str(tmp_path / "c")], ".json").count() == 0


def test_contents_come_once(spark, lake, topic_of, tmp_path):
    store, target = tmp_path / "store", str(tmp_path / "contents")
    for name, text in {"one.json": '{"n": 1}\n{"n": 2}', "two.json": '{"n": 3}\nbroken', "late.json": '{"n": 4}'}.items():
        (store / "b").mkdir(parents=True, exist_ok=True)
        if name != "late.json":
            (store / "b" / name).write_text(text)

    def told(*names):
        records = [{"eventName": "s3:ObjectCreated:Put", "s3": {"bucket": {"name": "b"}, "object": {"key": n}}} for n in names]
        return json.dumps({"Records": records})

    every = topic_of([told("one.json", "one.json"), told("two.json", "one.json", "late.json"), told("late.json"), told("gone.json")])
    lake.topic.publish(every.where("offset = 0"))
    lake.topic.publish(every.where("offset = 1"))
    fails = [2]

    def crash(batch):
        if batch == 1 and fails[0]:
            fails[0] -= 1
            raise OSError("down")

    sink = content_sink(str(store), str(store), target, ".json")
    for _ in range(2):
        with pytest.raises(Exception):
            lake.job(sinks=[sink], before_ack=crash).drain(spark)
    (store / "b" / "late.json").write_text('{"n": 4}')
    lake.topic.publish(every.where("offset >= 2"))
    lake.job(sinks=[sink], before_ack=crash).drain(spark)
    assert sorted(r.record for r in loaded_records(spark, target).collect()) == [f'{{"n": {n}}}' for n in (1, 2, 3, 4)]
    assert [r.record for r in loaded_records(spark, target, "bad").collect()] == ["broken"]
    assert sorted(r.object_key for r in loaded_keys(spark, target).collect()) == ["late.json", "one.json", "two.json"]
    assert loaded_records(spark, str(tmp_path / "nowhere")).count() == 0


def test_task_sink_commit_and_abort(spark, tmp_path):
    import pyarrow as pa

    writer = JsonFolderWriter(str(tmp_path))
    batch = pa.RecordBatch.from_pydict({"n": [1, 2]})
    one, two, none = writer.write(iter([batch])), writer.write(iter([batch, batch])), writer.write(iter([]))
    assert (one.rows, two.rows, none) == (2, 4, Staged(None, 0))
    assert whole_files(str(tmp_path)) == []
    writer.abort([one, None, none], 0)
    writer.commit([two, none], 0)
    (name,) = whole_files(str(tmp_path))
    # The batch again: what it staged goes.
    writer.commit([writer.write(iter([batch]))], 0)
    assert whole_files(str(tmp_path)) == [name] and os.listdir(tmp_path / "staged") == []
    assert whole_files(str(tmp_path / "nowhere")) == []


def test_task_sink_in_a_stream(spark, lake, topic_of):
    spark.dataSource.register(JsonFolder)
    lake.topic.publish(topic_of([EVENT] * 4))
    lake.topic.publish(topic_of([EVENT] * 6).where("offset > 3"))
    target = str(lake.path / "target")
    for _ in range(2):
        rows = rows_of(lake.topic.stream(spark)).select("kafka_offset")
        writer = rows.writeStream.format("json_folder").option("path", target).trigger(availableNow=True)
        writer.option("checkpointLocation", str(lake.path / "sink-cp")).start().awaitTermination()
    read = spark.read.json(whole_files(target))
    assert sorted(r.kafka_offset for r in read.collect()) == list(range(6))


def test_marks_find_the_stretches(spark, topic_of):
    rows = rows_of(topic_of([EVENT] * 60, partitions=2))
    # One row lost, one twice, one in place of another.
    hurt = rows.where("kafka_offset <> 3").unionAll(rows.where("kafka_partition = 1 and kafka_offset = 27"))
    swapped = F.when((F.col("kafka_partition") == 0) & (F.col("kafka_offset") == 15), 1).otherwise(F.col("record_index"))
    hurt = hurt.withColumn("record_index", swapped.cast("int"))
    found = differing_stretches(range_marks(rows, 10), range_marks(hurt.repartition(3), 10)).collect()
    assert sorted((r.kafka_partition, r.stretch, r.expected, r.present) for r in found) == [
        (0, 0, 10, 9), (0, 1, 10, 10), (1, 0, 10, 9), (1, 2, 10, 11),
    ]
    parts = [hurt.where("kafka_offset % 3 = 0"), hurt.where("kafka_offset % 3 <> 0")]
    kept = added_marks(range_marks(parts[0], 10).unionAll(range_marks(parts[1], 10)))
    assert differing_stretches(kept, range_marks(hurt, 10)).count() == 0
    balance = survival_by_stretch(rows, hurt, 10)
    # Only the rows of those four stretches were compared.
    assert balance.count() == 41 and balance.where("expected <> present").count() == 5
    want = key_balance(rows, hurt).where("expected <> present")
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, balance.where("expected <> present").collect()))
    assert differing_stretches(range_marks(rows.limit(0), 10), range_marks(rows.limit(0), 10)).count() == 0
