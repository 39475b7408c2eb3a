"""Topic options, offsets and object listing."""

import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from evlake.operators.offsets import consumer_lag, next_offsets, watermarks
from evlake.sources import objects
from evlake.sources.topic import FileTopic, KafkaTopic
from evlake.streaming.tables import IcebergTable


def test_kafka_options():
    topic = KafkaTopic("n", "h:9092", {"security.protocol": "SSL"}, start={1: 5, 0: 3}, max_messages=100, min_partitions=8)
    assert topic.read_options(streaming=True) == {
        "kafka.security.protocol": "SSL", "kafka.bootstrap.servers": "h:9092", "subscribe": "n",
        "startingOffsets": '{"n": {"0": 3, "1": 5}}', "minPartitions": "8", "maxOffsetsPerTrigger": "100",
    }
    assert "maxOffsetsPerTrigger" not in topic.read_options(streaming=False)
    assert KafkaTopic("n", "h").read_options(True)["startingOffsets"] == "earliest"
    assert topic.write_options()["topic"] == "n"


def test_iceberg_statements(spark):
    create = IcebergTable(spark, "lake", "ns", "events").create_statements()
    assert create[0] == "CREATE NAMESPACE IF NOT EXISTS lake.ns"
    assert "ingest_time timestamp NOT NULL" in create[1] and "raw_event string NOT NULL" in create[1]
    assert create[1].endswith("USING iceberg PARTITIONED BY (days(ingest_time))")


def test_file_topic_start(spark, topic_of, tmp_path):
    topic = FileTopic(str(tmp_path / "topic"))
    topic.publish(topic_of(["{}"] * 10, partitions=2))
    assert topic.batch(spark).count() == 10
    later = FileTopic(topic.path, start={0: 3})
    assert sorted((r.partition, r.offset) for r in later.batch(spark).collect()) == [
        (0, 3), (0, 4), (1, 0), (1, 1), (1, 2), (1, 3), (1, 4)
    ]


def test_next_offsets(spark):
    seen = [("t", 0, 10), ("t", 1, 5), ("t", 0, 11), ("t", 1, 3), ("t", None, 99), ("t", 2, None)]
    rows = spark.createDataFrame(seen, "kafka_topic string, kafka_partition int, kafka_offset long")
    assert {r.kafka_partition: r.next_offset for r in next_offsets(rows).collect()} == {0: 12, 1: 6}


def test_lag(spark, topic_of):
    marks = watermarks(topic_of(["{}"] * 10, partitions=2))
    schema = "kafka_topic string, kafka_partition int, next_offset long"

    def lag(done):
        r = consumer_lag(marks, spark.createDataFrame(done, schema)).head()
        return r.end_offset, r.retained, r.committed, r.lag

    assert lag([("t", 0, 3), ("t", 1, 4)]) == (10, 10, 7, 3)
    assert lag([("t", 0, -1)]) == (10, 10, None, None)
    assert lag([("t", 0, 40)]) == (10, 10, 40, 0)


def test_listing(spark, tmp_path):
    for name, size in [("a.parquet", 3), ("b/c.parquet", 5), ("b/d.txt", 7)]:
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"x" * size)
        os.utime(path, (1000 + size, 1000 + size))
    every = objects.list_objects(spark, str(tmp_path))
    assert tuple(objects.totals(every).head()) == (3, 15)
    assert [r.length for r in objects.latest(every, 2).collect()] == [7, 5]
    data = objects.list_objects(spark, str(tmp_path), ".parquet")
    assert tuple(objects.totals(data).head()) == (2, 8)
    assert objects.newest(data).head()[0].endswith("b/c.parquet")
    # Contents stay unread.
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan


def test_one_file_can_be_read_by_many_tasks(spark, tmp_path):
    topic = FileTopic(str(tmp_path / "topic"))
    value = F.concat(*[F.sha2((F.col("id") * 7 + i).cast("string"), 512) for i in range(8)]).cast("binary")
    rows = spark.range(16_000).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), value.alias("value"),
        F.current_timestamp().alias("timestamp"),
    )
    topic.publish(rows.coalesce(1))
    (file,) = [f for f in os.listdir(topic.path) if f.endswith(".parquet")]
    groups = pq.ParquetFile(f"{topic.path}/{file}").metadata
    assert groups.num_row_groups >= 4 and groups.num_rows == 16_000
    assert max(groups.row_group(i).num_rows for i in range(groups.num_row_groups)) < 8_000
