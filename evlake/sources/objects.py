"""Listing of stored objects: ``path``, ``length``, ``modificationTime``.

Spark's file index lists the folders in parallel and holds the listing on the
driver, so list one prefix (a day, a bucket) at a time on very large stores. The
summaries below take any DataFrame with the three columns, an inventory table
included.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evlake.fixed_values import LATEST_OBJECTS


def list_objects(spark: SparkSession, prefix: str, suffix: str | None = None) -> DataFrame:
    """Objects below ``prefix``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return only_objects(reader.load(prefix).select("path", "length", "modificationTime"), suffix)


def only_objects(listing: DataFrame, suffix: str | None = None) -> DataFrame:
    """Without folder markers, and with the given ending only."""
    kept = listing.where(~F.col("path").endswith("/"))
    return kept.where(F.col("path").endswith(suffix)) if suffix else kept


def totals(listing: DataFrame) -> DataFrame:
    return listing.agg(
        F.count("*").alias("objects"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def latest(listing: DataFrame, n: int = LATEST_OBJECTS) -> DataFrame:
    """The ``n`` most recently changed objects (a top-k, no full sort)."""
    return listing.orderBy(F.desc("modificationTime"), F.desc("path"), F.desc("length")).limit(n)


def newest(listing: DataFrame) -> DataFrame:
    """Path of the most recently changed object."""
    return listing.agg(
        F.max(F.struct("modificationTime", "path"))["path"].alias("newest_path")
    )
