"""Offset arithmetic per topic partition. Every result has one row per partition
at most, and every aggregate combines on the map side first."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def next_offsets(rows: DataFrame) -> DataFrame:
    """Offset to resume from: one past the highest seen, whatever the order.

    Rows without complete coordinates count for nothing.
    """
    known = rows.where(
        "kafka_topic is not null and kafka_partition is not null and kafka_offset is not null"
    )
    return known.groupBy("kafka_topic", "kafka_partition").agg(
        (F.max("kafka_offset") + 1).alias("next_offset")
    )


def watermarks(messages: DataFrame) -> DataFrame:
    """First retained and next offset of each topic partition."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"), (F.max("offset") + 1).alias("high")
    )


def topic_totals(marks: DataFrame) -> DataFrame:
    """End offset, retained messages and partitions of each topic."""
    return marks.groupBy("topic").agg(
        F.sum("high").alias("end_offset"),
        F.sum(F.col("high") - F.col("low")).alias("retained"),
        F.count("*").alias("partitions"),
    )


def consumer_lag(marks: DataFrame, committed: DataFrame) -> DataFrame:
    """Committed total and lag per topic; both null when no offset is known.

    ``committed`` has the columns of :func:`next_offsets`; negative offsets mean
    "none" and are left out.
    """
    valid = (
        committed.where("next_offset >= 0")
        .groupBy(F.col("kafka_topic").alias("topic"))
        .agg(F.sum("next_offset").alias("committed"))
    )
    return (
        topic_totals(marks)
        .join(valid, "topic", "left")
        .withColumn(
            "lag",
            F.when(
                F.col("committed").isNotNull(),
                F.greatest(F.lit(0), F.col("end_offset") - F.col("committed")),
            ),
        )
    )
