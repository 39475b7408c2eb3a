"""Copies of rows: finding them, and keeping one of each.

A replay may give one key any number of copies, so copies are always combined
before the shuffle and never gathered in one place.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evlake.schema import ROW_KEY

#: Identifies a message of a topic.
MESSAGE_KEY = ("topic", "partition", "offset")


def copy_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*ROW_KEY).agg(F.count("*").alias("copies"))


def duplicates(rows: DataFrame) -> DataFrame:
    """Keys present more than once, most copies first."""
    return copy_counts(rows).where("copies > 1").orderBy(F.desc("copies"), *ROW_KEY)


def drop_copies(rows: DataFrame) -> DataFrame:
    """One row per key: the earliest ingested, ties broken by the other columns.

    Each task keeps one row per key before the one shuffle there is (the window's group
    limit), so of a key copied very often only one row a task travels.
    """
    rest = [c for c in rows.columns if c not in ROW_KEY]
    order = [F.asc_nulls_first(c) for c in ["ingest_time", *[c for c in rest if c != "ingest_time"]]]
    rank = F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy(*order))
    return rows.withColumn("copy_rank", rank).where("copy_rank = 1").drop("copy_rank")


def drop_copies_streaming(
    rows: DataFrame, within: str, time: str = "ingest_time", key: Sequence[str] = tuple(ROW_KEY)
) -> DataFrame:
    """Streaming form: of rows with one key within ``within`` of each other the first
    stays. For messages, ``MESSAGE_KEY`` and their ``timestamp``.

    The state is a key per row and ends with the watermark. A row later than the
    watermark is dropped whether it is a copy or not, since what it could copy is
    forgotten; the query's progress counts those. Give the longest delay between a
    topic's partitions, or use :func:`new_rows`, which forgets nothing.
    """
    return rows.withWatermark(time, within).dropDuplicatesWithinWatermark(list(key))


def offset_ranges(rows: DataFrame) -> list:
    """Least and largest offset of each topic partition, one row each."""
    found = rows.groupBy(*ROW_KEY[:2]).agg(F.min("kafka_offset").alias("low"), F.max("kafka_offset").alias("high"))
    return found.where("low is not null").collect()


def in_ranges(ranges: list) -> Column:
    """Whether a row lies in one of the ranges; comparisons with constants, which reach
    the files' statistics."""
    inside = [
        F.col("kafka_topic").eqNullSafe(F.lit(r["kafka_topic"]))
        & F.col("kafka_partition").eqNullSafe(F.lit(r["kafka_partition"]))
        & F.col("kafka_offset").between(r["low"], r["high"])
        for r in ranges
    ]
    return reduce(lambda a, b: a | b, inside, F.lit(False))


def new_rows(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The rows whose keys are not in the table, one per key.

    Only the part of the table is read that the batch's offsets fall into, however long
    the table has become. Rows without complete coordinates have no key and stay.
    """
    known = table.where(in_ranges(offset_ranges(rows))).select(*ROW_KEY)
    keyed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ROW_KEY])
    fresh = drop_copies(rows.where(keyed)).join(known, ROW_KEY, "left_anti")
    return fresh.select(*rows.columns).unionByName(rows.where(~keyed))
