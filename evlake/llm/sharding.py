"""Contiguous shards of equal bytes.

Documents are put in order of id by a range partitioning and sorted where they are.
Each partition sums up its own sizes; the partitions' totals, one row each, are turned
into offsets; adding the offset gives every document its place in the bytes of the
whole. The place of its middle byte, cut at equal targets, names the shard, so the
shards are runs of documents whose bytes differ by about one document at most.

Only ids, sizes and checksums are sorted. An id that very many rows share is spread
by the row's checksum, and rows alike in both by a running number of their input
partition, so no key is one task's whole work. Equal texts are not brought together:
a large group of copies kept whole would leave the shards unequal.

Defined results: a null text has no bytes and counts 1, as an empty one; null ids come
first; rows repeated in full take places of their own. An empty table has no shards.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evlake.llm.common import stored, whole

SHARDS = 16


def byte_size(text: str) -> Column:
    return (F.octet_length(whole(text)) + 1).cast("long")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and bytes of the partition before each row."""
    part, rows, size_so_far = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        ends = np.cumsum(batch.column("size").to_numpy()) + size_so_far
        if not len(ends):
            continue
        starts = np.concatenate(([size_so_far], ends[:-1]))
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(np.full(len(ends), part, np.int32)),
                pa.array(np.arange(rows, rows + len(ends))),
                pa.array(starts),
            ],
            [*batch.schema.names, "part", "rows_before", "bytes_before"],
        )
        rows, size_so_far = rows + len(ends), int(ends[-1])


def shards(docs: DataFrame, n: int = SHARDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot (its place
    in the shard, from 0) and grown_shard (null: a new shard moves every cut)."""
    sized = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        byte_size(text_column).alias("size"),
        F.crc32(whole(text_column).cast("binary")).alias("text_crc32"),
        F.pmod(F.monotonically_increasing_id(), F.lit(1024)).alias("spread"),
    )
    order = [F.asc_nulls_first("doc_id"), F.asc("text_crc32"), F.asc("spread")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = sized.repartitionByRange(parts, *order).sortWithinPartitions("doc_id", "text_crc32")
    schema = "doc_id long, size long, text_crc32 long, part int, rows_before long, bytes_before long"
    placed = stored(ranged.drop("spread").mapInArrow(_running, schema), "running-bytes")
    # One row per partition; their sums are the only thing that is put in one order.
    ends = placed.groupBy("part").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    ends = stored(ends, "partition-totals")
    total = ends.agg(F.sum("bytes")).head()[0] or 1
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select(
        "part",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_offset"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_offset"),
    )
    row = F.col("rows_offset") + F.col("rows_before")
    middle = F.col("bytes_offset") + F.col("bytes_before") + F.floor((F.col("size") - 1) / 2)
    # Exact for any size: the product may pass 64 bits.
    shard = F.floor(middle.cast("decimal(38,0)") * n / F.lit(total).cast("decimal(20,0)")).cast("int")
    known = placed.join(F.broadcast(offsets), "part")
    known = known.select("doc_id", "size", "text_crc32", shard.alias("shard"), row.alias("row"))
    # At most n rows.
    first = known.groupBy("shard").agg(F.min("row").alias("first"))
    return known.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, n: int = SHARDS) -> None:
    """Write ``docs`` as a folder per shard, each in order of its slots. Ids must be
    unique."""
    placed = shards(docs, n).select(F.col("doc_id").alias("shard_doc_id"), F.col("shard").alias("shard_no"), "slot")
    joined = docs.join(placed, F.col("doc_id") == F.col("shard_doc_id")).drop("shard_doc_id")
    ordered = joined.repartitionByRange("shard_no", "slot").sortWithinPartitions("shard_no", "slot").drop("slot")
    ordered.write.partitionBy("shard_no").parquet(path)
