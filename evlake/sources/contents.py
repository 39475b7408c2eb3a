"""Reading the objects events tell of into a second table.

One job per format. Only objects an event told of are opened, with Spark's own
readers: each record as a JSON text with the object it came from. JSON may be lines or
whole documents, CSV files may have different headers, Parquet files different
columns. Records that cannot be parsed are kept apart.
"""

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evlake.operators.decode import whole_json
from evlake.sources.objects import list_objects

#: Formats by object name ending.
FORMATS = {".json": "json", ".txt": "json", ".csv": "csv", ".parquet": "parquet"}


def stored_objects(rows: DataFrame, suffix: str) -> DataFrame:
    """The distinct objects of a format that creation events name."""
    wanted = rows.where(
        F.col("object_key").endswith(suffix) & F.col("event_name").contains("ObjectCreated")
    )
    return wanted.groupBy("bucket", "object_key").agg(F.count("*").alias("events"))


def _places(spark: SparkSession, rows: DataFrame, store: str, prefix: str, suffix: str) -> list[str]:
    """Paths of the notified objects that are there.

    Names are compared with a listing, so that an object that is gone is no error;
    contents of other objects are never opened. Spark's file readers keep the paths
    they read on the driver, as this list.
    """
    notified = stored_objects(rows, suffix)
    found = list_objects(spark, prefix, suffix).select(
        "path",
        F.regexp_extract("path", f"{_quoted(store)}/*([^/]+)/(.*)$", 1).alias("bucket"),
        F.regexp_extract("path", f"{_quoted(store)}/*([^/]+)/(.*)$", 2).alias("object_key"),
    )
    return [r.path for r in found.join(notified, ["bucket", "object_key"], "left_semi").collect()]


def _json_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """JSON lines; a file with a line that is none may be one document as a whole."""
    path = F.col("_metadata.file_path").alias("path")
    lines = spark.read.text(paths).where(F.trim("value") != "").select("value", path)
    parsed = lines.withColumn("ok", _one_value(F.col("value")))
    bad = [r.path for r in parsed.where("not ok").select("path").distinct().collect()]
    good = _kept(parsed if not bad else parsed.where(~F.col("path").isin(bad)))
    if not bad:
        return good
    whole = spark.read.text([unquote(p) for p in bad], wholetext=True).select("value", path).withColumn("ok", _one_value(F.col("value")))
    documents = whole.where("ok")
    # Line by line after all, where the whole is no document either.
    broken = parsed.join(whole.where("not ok").select("path"), "path", "left_semi")
    return good.unionByName(_kept(documents)).unionByName(_kept(broken))


def _one_value(text: Column) -> Column:
    mark = F.xxhash64(text)
    return F.coalesce(F.try_variant_get(whole_json(text, mark), "$[1]", "bigint") == mark, F.lit(False))


def _kept(parsed: DataFrame) -> DataFrame:
    value, ok = F.col("value"), F.col("ok")
    return parsed.select("path", F.when(ok, value).alias("record"), F.when(~ok, value).alias("bad"))


def _csv_records(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Each file by its own header; files with the same header are read together. A
    line with more or fewer fields than the header is kept as it is."""
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"),
    )
    # The first line of the block that starts the file; and whether a quoted field may go
    # on in the next line. Only such files have to be read by one task each.
    odd = [F.regexp_count("value", F.lit(quote)) % 2 == 1 for quote in ('"', r'(?<!\\)"')]
    files = lines.groupBy("path").agg(
        F.min_by("value", F.when(F.col("at") == 0, F.col("line"))).alias("header"),
        F.bool_or(odd[0] | odd[1]).alias("over_lines"),
    )
    by_header = files.groupBy("header", "over_lines").agg(F.collect_list("path").alias("paths")).collect()
    parts = []
    for row in by_header:
        names = next(csv.reader([row.header.lstrip("\ufeff")]))
        bad = "bad"
        while bad in names:
            bad += "_"
        names = [n if n and names.count(n) == 1 else f"{n}_{i}" for i, n in enumerate(names)]
        shape = T.StructType([T.StructField(n, T.StringType()) for n in [*names, bad]])
        table = (
            spark.read.schema(shape).option("header", "true").option("columnNameOfCorruptRecord", bad)
            .option("multiLine", row.over_lines).option("mode", "PERMISSIVE").csv([unquote(p) for p in row.paths])
        )
        quoted = [F.col(f"`{n}`") for n in names]
        # The file's path comes along before any column is dropped.
        wrong = F.col(f"`{bad}`")
        record = F.when(wrong.isNull(), F.to_json(F.struct(*quoted)))
        parts.append(table.select(F.col("_metadata.file_path").alias("path"), record.alias("record"), wrong.alias("bad")))
    return reduce(DataFrame.unionByName, parts) if parts else None


def _parquet_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All columns any of the files has; a record shows those of its own that are set."""
    table = spark.read.option("mergeSchema", "true").parquet(*paths)
    return table.select(
        F.col("_metadata.file_path").alias("path"),
        F.to_json(F.struct("*")).alias("record"),
        F.lit(None).cast("string").alias("bad"),
    )


def object_records(spark: SparkSession, rows: DataFrame, store: str, prefix: str, suffix: str) -> DataFrame:
    """Records of all notified objects with the ending ``suffix``.

    ``store`` is the address buckets lie under (``s3a://`` or a folder), ``prefix``
    the part of it to look in. Repeated events add no records: objects are matched
    after combining their events. What cannot be parsed is in ``bad``.
    """
    paths = _places(spark, rows, store, prefix, suffix)
    readers = {"json": _json_records, "csv": _csv_records, "parquet": _parquet_records}
    found = readers[FORMATS[suffix]](spark, paths) if paths else None
    if found is None:
        return spark.createDataFrame([], "bucket string, object_key string, record string, bad string")
    # A file's path comes back escaped.
    path = F.try_url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    parts = [F.regexp_extract(path, f"{_quoted(store)}/*([^/]+)/(.*)$", i) for i in (1, 2)]
    return found.select(parts[0].alias("bucket"), parts[1].alias("object_key"), "record", "bad")


def _quoted(text: str) -> str:
    """Text as a pattern that matches it, whatever slashes lead or end it."""
    return r"\Q" + text.strip("/") + r"\E"
