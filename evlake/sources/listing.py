"""Listing of stored objects by the tasks: ``path``, ``length``, ``modificationTime``.

A data source whose partitions are prefixes. Each is listed in its task, through the
file system its address names, and handed over in batches; the driver knows the prefixes
only. For stores whose listing does not fit one machine; of a few thousand objects
:func:`evlake.sources.objects.list_objects` is quicker.
"""

from collections.abc import Iterator, Sequence
import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, length bigint, modificationTime timestamp"
_BATCH = 10_000


class Prefix(InputPartition):
    def __init__(self, address: str):
        self.address = address


class PrefixReader(DataSourceReader):
    def __init__(self, prefixes: Sequence[str], suffix: str):
        self.prefixes, self.suffix = prefixes, suffix

    def partitions(self) -> list[Prefix]:
        return [Prefix(p) for p in self.prefixes]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in _objects(partition.address):
            # Folder markers are no objects.
            if row[0].endswith(self.suffix) and not row[0].endswith("/"):
                rows.append(row)
            if len(rows) == _BATCH:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


class ObjectListing(DataSource):
    """Options: ``prefixes``, a JSON list of addresses below which to list (each one
    task); ``suffix``, the ending names must have."""

    @classmethod
    def name(cls) -> str:
        return "object_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PrefixReader:
        return PrefixReader(json.loads(self.options["prefixes"]), self.options.get("suffix", ""))


def _objects(address: str) -> Iterator[tuple]:
    """Objects below an address, folder by folder, so that one folder's names are held
    at a time. A prefix that is not there has none."""
    from pyarrow import fs

    scheme = f"{address.split(':', 1)[0]}://" if "://" in address else ""
    # Hadoop spells these stores' scheme differently.
    known = address.replace("s3a://", "s3://", 1)
    store, root = fs.FileSystem.from_uri(known if "://" in known or known.startswith("file:") else f"file://{known}")
    todo = [root]
    while todo:
        for info in store.get_file_info(fs.FileSelector(todo.pop(), allow_not_found=True)):
            if info.type == fs.FileType.Directory:
                todo.append(info.path)
            elif info.type == fs.FileType.File:
                yield f"{scheme}{info.path}", info.size, info.mtime


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.timestamp("us", tz="UTC")]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)],
        ["path", "length", "modificationTime"],
    )


def list_prefixes(spark: SparkSession, prefixes: Sequence[str], suffix: str = "") -> DataFrame:
    """The objects below each of the prefixes, which must not lie within each other."""
    spark.dataSource.register(ObjectListing)
    reader = spark.read.format("object_listing").option("prefixes", json.dumps(list(prefixes)))
    return reader.option("suffix", suffix).load()


def sub_prefixes(spark: SparkSession, root: str) -> list[str]:
    """The folders right below ``root``, to be listed one by one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(s.getPath().toString()) for s in files.listStatus(path) if s.isDirectory()]
