"""The plans are the ones intended."""

import json

from pyspark.sql import functions as F

from evlake.operators.copies import drop_copies
from evlake.operators.decode import decode
from evlake.operators.flatten import flatten
from evlake.plans import reconcile, table_queries
from evlake.registered import inputs
from evlake.sources.topic import FileTopic


def explained(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def rows_of(spark, topic_of, tmp_path):
    topic = FileTopic(str(tmp_path / "topic"))
    topic.publish(topic_of([json.dumps({"Records": [{"eventName": "n"}]})] * 4))
    return flatten(decode(topic.batch(spark)), F.col("timestamp"))


def test_flatten_is_narrow_and_free_of_python(spark, topic_of, tmp_path):
    optimized, physical = explained(rows_of(spark, topic_of, tmp_path))
    assert "Python" not in physical and "Exchange" not in physical
    assert optimized.count("parseJson") == 1, "every message is parsed once"


def test_unused_fields_are_not_computed(spark, topic_of, tmp_path):
    rows = rows_of(spark, topic_of, tmp_path).groupBy("event_name").count()
    optimized, physical = explained(rows)
    assert "url_decode" not in optimized.lower() and "objectSize" not in optimized
    assert "partial_count" in physical


def test_filters_reach_the_topic_files(spark, topic_of, tmp_path):
    some = rows_of(spark, topic_of, tmp_path).where("kafka_partition = 0 and kafka_offset > 2")
    _, physical = explained(some)
    assert "GreaterThan(offset,2)" in physical and some.count() == 1


def test_filter_on_a_computed_field_does_not_parse_twice(spark, topic_of, tmp_path):
    some = rows_of(spark, topic_of, tmp_path).where("event_name = 'n' and bucket is null")
    optimized, _ = explained(some)
    assert optimized.count("parseJson") == 1 and some.count() == 4


def test_latest_is_a_top_k(spark, topic_of, tmp_path):
    _, physical = explained(table_queries.latest_events(rows_of(spark, topic_of, tmp_path)))
    assert "TakeOrderedAndProject" in physical


def test_no_join_for_losses(spark, topic_of, tmp_path):
    rows = rows_of(spark, topic_of, tmp_path)
    _, physical = explained(reconcile.survival(rows, rows))
    assert "Join" not in physical and "partial_" in physical


def test_only_keys_with_copies_are_ranked(spark, topic_of, tmp_path):
    _, physical = explained(drop_copies(rows_of(spark, topic_of, tmp_path)))
    # Keys are counted by hash aggregates without the payload; the rank comes after the
    # semi join, and all but a task's first copy stay behind.
    assert "SortAggregate" not in physical and "HashAggregate" in physical
    assert "WindowGroupLimit" in physical and physical.index("WindowGroupLimit") < physical.index("LeftSemi")


def test_messages_are_made_after_the_events_are_spread(spark, tmp_path):
    columns = "id AS event_id, timestamp_ntz'2024-01-02 03:04:05' AS ts, id AS user_id, 'view' AS event_type, 1.5D AS value"
    spark.range(200).selectExpr(*columns.split(", ")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    made = inputs.notified(spark, str(tmp_path))
    # Also where one file is written for each topic partition: the filter goes below.
    for df, exchanges in ((made, 1), (made.where("partition = 1").repartition(1), 2)):
        optimized, physical = explained(df)
        assert physical.count("Exchange") == exchanges
        spread = physical.index("Exchange hashpartitioning(event_id")
        assert "md5" in physical[:spread] and "md5" not in physical[spread:]
    assert made.count() == 200
