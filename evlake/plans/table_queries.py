"""Questions asked of the object-event table."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evlake.fixed_values import LATEST_EVENTS
from evlake.schema import DAY, EVENTS


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("n_rows"))


def latest_events(rows: DataFrame, n: int = LATEST_EVENTS) -> DataFrame:
    """The ``n`` rows ingested last (a top-k, no full sort). Partition and record
    position break ties."""
    order = ["ingest_time", "kafka_offset", "kafka_partition", "record_index"]
    shown = ["ingest_time", "event_name", "bucket", "object_key", "object_size"]
    return rows.orderBy(*[F.desc(c) for c in order]).limit(n).select(*shown)


def count_by_path(rows: DataFrame, path: str, name: str) -> DataFrame:
    """Rows by a scalar inside the raw payload, for fields without a column."""
    return rows.groupBy(F.get_json_object("raw_event", path).alias(name)).agg(
        F.count("*").alias("n_rows")
    )


def null_audit(rows: DataFrame) -> DataFrame:
    """Nulls per column, in one pass."""
    names = [c for c in rows.columns if c in EVENTS.fieldNames()]
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in names]
    return counted.select(F.inline(F.array(*pairs)))


def between(rows: DataFrame, start, end) -> DataFrame:
    """Rows ingested in ``[start, end)``.

    A filter on ``ingest_time`` alone prunes no day folder, so the day is
    filtered as well wherever the table still shows its partition column.
    ``start`` and ``end`` are datetimes, or their text in ISO form; without a zone
    they are in UTC.
    """
    first, last = (moment(t) for t in (start, end))
    kept = rows.where((F.col("ingest_time") >= F.lit(first)) & (F.col("ingest_time") < F.lit(last)))
    if DAY in rows.columns:
        kept = kept.where(F.col(DAY).between(F.lit(first.date()), F.lit(last.date())))
    return kept


def moment(when: dt.datetime | str) -> dt.datetime:
    """A point in time in UTC."""
    if isinstance(when, str):
        when = dt.datetime.fromisoformat(when)
    return when.replace(tzinfo=dt.timezone.utc) if when.tzinfo is None else when.astimezone(dt.timezone.utc)
