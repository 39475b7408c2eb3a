"""Samples, rates, levels and reconciliation on small fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from evlake.plans import progress, reconcile

KEYS = "kafka_topic string, kafka_partition int, kafka_offset long, record_index int"


def samples(spark, values, step=5.0):
    rows = [(p, i * step, v) for p, vs in values.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "pipeline string, t double, v long")


def test_rates_of_a_pair(spark):
    schema = "pipeline string, t double, source_objects long, topic_end long, table_rows long"
    pair = spark.createDataFrame([("p", 3.0, 70, 66, 41), ("p", 7.0, 131, 90, 50)], schema)
    last = progress.rates(pair, ["source_objects", "topic_end", "table_rows"]).orderBy("t").collect()
    assert last[0].source_objects_rate is None
    assert [last[1][f"{c}_rate"] for c in ("source_objects", "topic_end", "table_rows")] == [15.25, 6.0, 2.25]


@pytest.mark.parametrize("width", [1, 7, 12, 1000])
def test_rates_across_slices(spark, width):
    values = {"a": [1, 4, None, 9, 30, 31, 31], "b": [5, 6]}
    got = progress.rates(samples(spark, values), ["v"], width).collect()
    expected = {}
    for p, vs in values.items():
        for i, v in enumerate(vs):
            old = vs[i - 1] if i else None
            expected[(p, i * 5.0)] = None if v is None or old is None else (v - old) / 5.0
    assert {(r.pipeline, r.t): r.v_rate for r in got} == expected


def test_levels(spark):
    def of(values, width, steps):
        got = progress.levels(samples(spark, {"p": values}), "v", width, steps).orderBy("t").collect()
        return [r.level for r in got]

    assert of([10, 12, 14, 24], 4, 8) == [0, 1, 2, 7]
    assert of([9, 9], 2, 6) == [3, 3]
    assert of([0, None, 10, 5], 4, 8) == [0, None, 7, 4]
    assert of([None, None], 2, 8) == [None, None]
    assert of([100, 0, 1, 4], 3, 3) == [0, 0, 2]


def test_history_is_limited_before_the_shuffle(spark):
    window = progress.history_window(samples(spark, {"p": list(range(100)), "q": [1]}))
    assert window.groupBy("pipeline").count().orderBy("pipeline").collect() == [("p", 72), ("q", 1)]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_failed_stage_is_isolated(spark):
    def broken():
        raise ConnectionError("no route")

    stages = {
        "source": broken,
        "topic": lambda: spark.sql("select 7L as topic_end, 3L as topic_retained"),
        "table": lambda: spark.sql("select assert_true(false), 1L as table_rows"),
    }
    row = progress.take_sample(spark, "p", 1.0, stages).head()
    assert (row.topic_end, row.topic_retained, row.source_objects, row.table_rows) == (7, 3, None, None)
    assert set(row.errors) == {"source", "table"} and row.errors["source"] == "ConnectionError: no route"


def test_recent_commits(spark):
    times = [dt.datetime(2026, 1, 1, 0, i) for i in range(8)]
    history = spark.createDataFrame(
        [(t, "append", i, "r", i) for i, t in enumerate(times)],
        "committed_at timestamp, operation string, added long, run_id string, snapshot_id long",
    )
    assert [r.added for r in progress.recent_commits(history).collect()] == [3, 4, 5, 6, 7]


def test_reconcile(spark):
    expected = spark.createDataFrame([("t", 0, i, 0) for i in range(10)], KEYS)
    table = expected.where("kafka_offset <> 3").unionAll(expected.where("kafka_offset < 2"))
    result = reconcile.survival(expected, table).head()
    assert tuple(result) == (10, 1, 2, False)
    assert [r.kafka_offset for r in reconcile.lost_rows(expected, table).collect()] == [3]
    assert tuple(reconcile.survival(expected, expected).head()) == (10, 0, 0, True)
    empty = expected.limit(0)
    assert tuple(reconcile.growth(empty, expected, expected).head()) == (0, 10, 10, 10, True)
    assert reconcile.growth(expected, table, empty).head().exact is False
    two = spark.range(2).select("id")
    assert reconcile.batching_holds(empty, two, expected).head().batched is True
    assert reconcile.batching_holds(empty, expected, expected).head().batched is False


def test_warehouse_must_be_elsewhere(spark):
    reconcile.separate_buckets("s3://in/x", "s3a://out/y")
    reconcile.separate_buckets("in", "/local/folder")
    with pytest.raises(ValueError):
        reconcile.separate_buckets("s3://in/x", "s3a://in/warehouse")


def test_one_hot_key_is_combined_before_the_shuffle(spark):
    """Copies of one key meet as one row per task, in both ways of looking at them."""
    from evlake.operators.copies import copy_counts

    hot = spark.range(0, 30000, 1, 6).select(
        F.lit("t").alias("kafka_topic"), F.lit(0).alias("kafka_partition"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("kafka_offset"), F.lit(0).alias("record_index"),
    )
    counts = {r.kafka_offset: r.copies for r in copy_counts(hot).where("copies > 1").collect()}
    assert counts == {0: 10000}
    plan = copy_counts(hot)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
