"""Progress of data from store to topic to table, sampled over time.

A sample is one row per pipeline and time. Columns: ``pipeline``, ``t``
(seconds), and the counters of :data:`COUNTERS`.
"""

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evlake.fixed_values import HISTORY_SAMPLES, LATEST_COMMITS
from evlake.functions import progress_math as pm

COUNTERS = [
    "source_objects", "source_bytes",
    "topic_end", "topic_retained", "topic_committed", "topic_lag", "topic_partitions",
    "table_rows", "table_files", "table_commits", "last_added", "last_commit_age_s",
    "data_files", "metadata_files",
]

#: Width in seconds of the time slices a long history is worked in.
SLICE = 86_400


# -- one sample ---------------------------------------------------------------


def table_metrics(live: DataFrame, history: DataFrame, now: dt.datetime) -> DataFrame:
    """Rows, files, commits, size and age of the last commit; one row.

    Reads the commit ledger only, never the data.
    """
    # One aggregate over both tables, told apart by which columns they fill.
    both = live.select("n_rows", "n_files").unionByName(
        history.select(F.struct("committed_at", "snapshot_id", "added").alias("commit")), allowMissingColumns=True
    )
    found = both.agg(
        F.sum("n_rows").alias("table_rows"),
        F.sum("n_files").alias("table_files"),
        F.count("commit").alias("table_commits"),
        F.max("commit").alias("last"),
    )
    age = F.unix_micros(F.lit(now)) - F.unix_micros("last.committed_at")
    return found.select(
        "table_rows",
        "table_files",
        "table_commits",
        F.col("last.added").alias("last_added"),
        F.greatest(F.lit(0.0), age / 1e6).alias("last_commit_age_s"),
    )


def recent_commits(history: DataFrame, n: int = LATEST_COMMITS) -> DataFrame:
    newest = history.orderBy(F.desc("snapshot_id")).limit(n)
    return newest.orderBy("snapshot_id").select("committed_at", "operation", "added")


def warehouse_counts(listing: DataFrame) -> DataFrame:
    """Data and metadata objects of a table, from a listing of its folder."""
    is_data = F.col("path").contains("/data/") & F.col("path").endswith(".parquet")
    return listing.where(~F.col("path").endswith("/")).agg(
        F.count_if(is_data).alias("data_files"),
        F.count_if(F.col("path").contains("/metadata/")).alias("metadata_files"),
        F.max_by(F.when(is_data, F.col("path")), F.when(is_data, F.col("modificationTime"))).alias(
            "newest_data_file"
        ),
    )


def take_sample(
    spark: SparkSession, pipeline: str, t: float, stages: Mapping[str, Callable[[], DataFrame]]
) -> DataFrame:
    """Collect every stage on its own into one sample row.

    Each stage gives a one-row DataFrame with some of :data:`COUNTERS`. A stage
    that fails leaves its counters null and its message in ``errors``.
    """
    values, errors = dict.fromkeys(COUNTERS), {}
    for name, stage in stages.items():
        try:
            row = stage().head()
            values.update({k: v for k, v in row.asDict().items() if k in values})
        except Exception as e:
            errors[name] = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
    double = {"last_commit_age_s"}
    schema = T.StructType(
        [T.StructField("pipeline", T.StringType()), T.StructField("t", T.DoubleType())]
        + [T.StructField(c, T.DoubleType() if c in double else T.LongType()) for c in COUNTERS]
        + [T.StructField("errors", T.MapType(T.StringType(), T.StringType()))]
    )
    row = [float(v) if c in double and v is not None else v for c, v in values.items()]
    return spark.createDataFrame([(pipeline, t, *row, errors)], schema)


# -- over a history of samples ------------------------------------------------


def history_window(samples: DataFrame, n: int = HISTORY_SAMPLES) -> DataFrame:
    """The last ``n`` samples per pipeline. Spark limits each pipeline to ``n``
    rows before the shuffle."""
    newest = Window.partitionBy("pipeline").orderBy(F.desc("t"))
    return samples.withColumn("_age", F.row_number().over(newest)).where(f"_age <= {n}").drop("_age")


def with_previous(samples: DataFrame, columns: list[str], width: int = SLICE) -> DataFrame:
    """Add ``previous``: the given columns of the sample before, per pipeline.

    Works in time slices, so that one long history is not one task: inside a
    slice by a window, across slices by the last sample of the slice before.
    """
    wanted = F.struct("t", *columns)
    sliced = samples.withColumn("_slice", F.floor(F.col("t") / width))
    last = sliced.groupBy("pipeline", "_slice").agg(F.max_by(wanted, "t").alias("_last"))
    by_slice = Window.partitionBy("pipeline").orderBy("_slice")
    carried = last.select("pipeline", "_slice", F.lag("_last").over(by_slice).alias("_carried"))
    inside = Window.partitionBy("pipeline", "_slice").orderBy("t")
    return (
        sliced.join(carried, ["pipeline", "_slice"])
        .withColumn("previous", F.coalesce(F.lag(wanted).over(inside), F.col("_carried")))
        .drop("_slice", "_carried")
    )


def rates(samples: DataFrame, columns: list[str], width: int = SLICE) -> DataFrame:
    """Add ``<column>_rate``, the change per second since the sample before."""
    paired = with_previous(samples, columns, width)
    elapsed = F.col("t") - F.col("previous.t")
    return paired.withColumns(
        {f"{c}_rate": pm.rate(F.col(f"previous.{c}"), F.col(c), elapsed) for c in columns}
    ).drop("previous")


def stage_gaps(samples: DataFrame, batch_size: int) -> DataFrame:
    """Distances between the stages, lag, rows per file and the scale to draw at."""
    on_topic = pm.topic_count(F.col("topic_retained"), F.col("topic_end"))
    waiting = pm.floored_gap(on_topic, F.col("table_rows"))
    return samples.select(
        "pipeline",
        "t",
        on_topic.alias("on_topic"),
        pm.floored_gap(F.col("source_objects"), on_topic).alias("topic_behind"),
        waiting.alias("table_behind"),
        pm.effective_lag(F.col("topic_lag"), on_topic, F.col("table_rows")).alias("lag"),
        pm.is_buffering(waiting, batch_size).alias("buffering"),
        pm.mean_file_rows(F.col("table_rows"), F.col("data_files")).alias("rows_per_file"),
        pm.axis_top(
            F.greatest("source_objects", on_topic, "table_rows")
        ).alias("scale"),
    )


def levels(samples: DataFrame, column: str, width: int, steps: int) -> DataFrame:
    """The last ``width`` values per pipeline scaled to 0..steps-1.

    A constant series sits in the middle; a missing value stays null.
    """
    shown = history_window(samples, width)
    over = Window.partitionBy("pipeline")
    low, high = F.min(column).over(over), F.max(column).over(over)
    scaled = F.bround((F.col(column) - low) / (high - low) * (steps - 1)).cast("int")
    level = F.when(F.col(column).isNotNull(), F.when(high > low, scaled).otherwise(steps // 2))
    return shown.select("pipeline", "t", column, level.alias("level"))
