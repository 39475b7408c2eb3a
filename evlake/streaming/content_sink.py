"""Object contents loaded as events arrive.

A sink of the ingestion job. The objects a batch tells of, less those loaded by earlier
batches, are read and their records written with the batch: records, bad records and, at
last, the keys that were loaded, each in a folder per run and batch. The keys make the
batch count; a batch that is repeated after a failure replaces its own folders, so an
object is loaded once however often it is told of. An object told of before it is there
is left for the next event that names it.
"""

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evlake.schema import OBJECT_KEYS
from evlake.sources.contents import object_records, stored_objects
from evlake.streaming.ingest import Sink, query_id

_BATCH = ["run_id", "batch_id"]


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows below ``path``, none before anything was written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def loaded_keys(spark: SparkSession, target: str) -> DataFrame:
    return _read(spark, f"{target}/keys", f"{OBJECT_KEYS}, run_id string, batch_id long")


def loaded_records(spark: SparkSession, target: str, kind: str = "records") -> DataFrame:
    """The records (or ``kind="bad"``) of all batches that count."""
    counts = loaded_keys(spark, target).select(*_BATCH).distinct()
    rows = _read(spark, f"{target}/{kind}", f"{OBJECT_KEYS}, record string, run_id string, batch_id long")
    # As many rows as batches.
    return rows.join(counts, _BATCH, "left_semi").drop(*_BATCH)


def content_sink(store: str, prefix: str, target: str, suffix: str) -> Sink:
    """Loads the objects with the ending ``suffix`` into ``target``; ``store`` and
    ``prefix`` as in :func:`evlake.sources.contents.object_records`."""

    def write(rows: DataFrame, decoded: DataFrame, batch_id: int) -> None:
        spark = decoded.sparkSession
        run = query_id(spark)
        told = stored_objects(rows, suffix).select("bucket", "object_key")
        before = loaded_keys(spark, target)
        before = before.where(~((F.col("run_id") == run) & (F.col("batch_id") == batch_id)))
        fresh = told.join(before, ["bucket", "object_key"], "left_anti")
        named = fresh.withColumn("event_name", F.lit("s3:ObjectCreated:Put")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if named.isEmpty():
                return
            found = object_records(spark, named, store, prefix, suffix)
            folder = f"run_id={run}/batch_id={batch_id}"
            for kind, column in (("records", "record"), ("bad", "bad")):
                part = found.where(F.col(column).isNotNull())
                part = part.select("bucket", "object_key", F.col(column).alias("record"))
                part.write.mode("overwrite").parquet(f"{target}/{kind}/{folder}")
            there = found.select("bucket", "object_key").distinct()
            there.write.mode("overwrite").parquet(f"{target}/keys/{folder}")
        finally:
            named.unpersist()

    return Sink("contents", write, required=True)
