"""Inputs of the registered queries, all derived by Spark from the given tables."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evlake.operators.decode import decode
from evlake.operators.flatten import flatten
from evlake.schema import TOPIC
from evlake.session import configure, new_folder
from evlake.sources.notifications import TOPIC_NAME, notifications
from evlake.sources.topic import FileTopic
from evlake.streaming.tables import ParquetTable

_made: dict[tuple, object] = {}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/events.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/conversations.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/documents.parquet")


def _once(spark: SparkSession, what: str, sf_dir: str, make):
    """Written inputs are made once per session and data folder."""
    key = (spark.sparkContext.applicationId, what, sf_dir)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def notified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message for every event. The events are spread before, whatever files they came
    in: they are short, and making the messages is the work."""
    return notifications(events(spark, sf_dir).repartition("event_id"))


def topic(spark: SparkSession, sf_dir: str) -> FileTopic:
    """All events published as notifications."""

    def make() -> FileTopic:
        made = FileTopic(new_folder(spark, "topic"))
        made.publish(notified(spark, sf_dir))
        return made

    return _once(spark, "topic", sf_dir, make)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic(spark, sf_dir).batch(spark)


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table rows of the whole topic; a message counts as ingested when sent."""
    return flatten(decode(messages(spark, sf_dir)), F.col("timestamp"))


def utc(*args: int) -> dt.datetime:
    return dt.datetime(*args, tzinfo=dt.timezone.utc)


#: Ends of the ingest periods, each committed at its end.
COMMIT_TIMES = [utc(2024, 1, 11), utc(2024, 1, 21), utc(2024, 3, 1)]


def table(spark: SparkSession, sf_dir: str) -> ParquetTable:
    """The object-event table holding the whole topic in three commits."""

    def make() -> ParquetTable:
        made = new_table(spark, "lake")
        source, start = rows(spark, sf_dir), utc(1970, 1, 1)
        for batch, end in enumerate(COMMIT_TIMES):
            time = F.col("ingest_time")
            period = source.where(time >= F.lit(start))
            # The last period is open, so that no event is left out.
            if end != COMMIT_TIMES[-1]:
                period = period.where(time < F.lit(end))
            made.append(period, "load", batch, end, gather_days=True)
            start = end
        return made

    return _once(spark, "table", sf_dir, make)


def new_table(spark: SparkSession, name: str) -> ParquetTable:
    return ParquetTable(spark, new_folder(spark, name), "lake", "object_events").open()


def payload_rows(spark: SparkSession, sf_dir: str, payload_sql: str) -> DataFrame:
    """Table rows for one custom payload per event; the offset is the event id."""
    made = events(spark, sf_dir).select(
        F.lit(TOPIC_NAME).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.expr(payload_sql).cast("binary").alias("value"),
        F.lit(utc(2024, 1, 1)).alias("timestamp"),
    )
    return flatten(decode(made.select(*TOPIC.fieldNames())), F.col("timestamp"))


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table plus a second copy of every row in one bucket in seven."""
    once = table(spark, sf_dir).read()
    return once.unionAll(once.where("bucket = 'bucket-0'"))


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replayed table without the rows of another bucket."""
    return replayed(spark, sf_dir).where("bucket is null or bucket <> 'bucket-1'")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored object per event, a folder marker for every fiftieth."""
    return events(spark, sf_dir).selectExpr(
        "'s3://store/' || event_type || '/object-' || event_id"
        " || CASE WHEN event_id % 50 = 0 THEN '/' WHEN event_id % 3 = 0 THEN '.parquet' ELSE '.dat' END AS path",
        "cast(floor(value * 100) as bigint) AS length",
        "timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)) AS modificationTime",
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress samples: one per user group and hour, with running totals."""
    hourly = (
        events(spark, sf_dir)
        .selectExpr(
            "'group-' || (user_id % 5) AS pipeline",
            "timestampdiff(HOUR, TIMESTAMP_NTZ'1970-01-01 00:00:00', date_trunc('HOUR', ts)) AS hour",
            "event_type",
        )
        .groupBy("pipeline", "hour")
        .agg(
            F.count("*").alias("s"),
            F.count_if(F.expr("event_type <> 'error'")).alias("k"),
            F.count_if(F.expr("event_type in ('click', 'view')")).alias("r"),
            F.count_if(F.expr("event_type = 'purchase'")).alias("f"),
        )
    )
    total = "sum({}) OVER (PARTITION BY pipeline ORDER BY hour)"
    return hourly.selectExpr(
        "pipeline",
        "cast(hour * 3600 as double) AS t",
        f"{total.format('s')} AS source_objects",
        f"{total.format('k')} AS topic_end",
        f"CASE WHEN hour % 7 <> 0 THEN {total.format('k')} - 3 END AS topic_retained",
        f"CASE WHEN hour % 5 <> 0 THEN {total.format('k')} - {total.format('r')} END AS topic_lag",
        f"CASE WHEN hour % 11 <> 0 THEN {total.format('r')} END AS table_rows",
        f"{total.format('f')} AS data_files",
    )
