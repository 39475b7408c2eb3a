"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. Sorting the distinct
blocks gives each an integer name; adjacent names are paired, the distinct pairs are
sorted and named in turn, and so on until a single name is left. Equal texts, and
only those, have equal byte length and equal last name: no hash decides anything.

Names are dense ranks within a bucket of the key's hash, with the bucket's number in
front. They depend on the keys alone, so a recomputed task finds the same names. A
block or pair that a large part of all rows shares is named from a broadcast table
(at most ``HOT_PART`` keys) and never meets its copies in one task.

Defined results: a null text counts as empty; empty texts are copies of each other;
rows repeated with the same id form one group of which one row stays; a null id is
the smallest. An empty table gives an empty result. Other columns are not looked at.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evlake.llm.common import HOT_PART, KEY, NO_ID, drop_stored, row_key, stored, whole, with_lookup

#: Bytes of a block.
BLOCK_BYTES = 1024

#: Rows a naming bucket holds on average.
BUCKET_ROWS = 2000


def _named(rows: DataFrame, keys: list[str], total: int, often: DataFrame) -> DataFrame:
    """``rows`` with an integer ``name`` instead of ``keys``; equal keys, equal names.

    ``often`` holds the hashes of hot keys; it only chooses the way a row takes.
    """
    buckets = max(1, total // BUCKET_ROWS)
    rows = rows.withColumn("key_hash", F.xxhash64(*keys))
    few = F.broadcast(often)
    hot = rows.join(few, "key_hash")
    ranked = (
        hot.select(*keys).distinct().withColumn("name", -F.dense_rank().over(Window.orderBy(*keys)).cast("long"))
    )
    same = [hot[k].eqNullSafe(ranked[k]) for k in keys]
    from_table = hot.join(F.broadcast(ranked), same).select(*[hot[c] for c in KEY], hot["pos"], "name")
    in_bucket = Window.partitionBy("bucket").orderBy(*keys)
    name = F.shiftleft(F.col("bucket"), 32) + F.dense_rank().over(in_bucket)
    rest = (
        rows.join(few, "key_hash", "left_anti")
        .withColumn("bucket", F.pmod("key_hash", F.lit(buckets)))
        .select(*KEY, "pos", name.alias("name"))
    )
    return rest.unionByName(from_table)


def _often(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """Hashes that over one in ``HOT_PART`` rows have, and the number of rows."""
    counts = stored(rows.groupBy(F.xxhash64(*keys).alias("key_hash")).count(), "key-counts")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).head()[0]
    often = counts.where(F.col("count") * HOT_PART > total).select("key_hash").collect()
    drop_stored(counts)
    # At most HOT_PART numbers.
    return rows.sparkSession.createDataFrame([tuple(r) for r in often], "key_hash long"), total


def identities(texts: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row key of ``texts`` (``KEY`` and ``text``) with its ``name``."""
    binary = F.col("text").cast("binary")
    cut: Column = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("row_bytes") / block_bytes) - 1).cast("int")),
        lambda i: binary.substr(i * block_bytes + 1, F.lit(block_bytes)),
    )
    rows, keys = texts.select(*KEY, F.posexplode(cut).alias("pos", "block")), ["block"]
    blocks = F.ceil(F.col("row_bytes") / block_bytes)
    most, level, done, old = None, 0, [], None
    while True:
        often, total = _often(rows, keys)
        names = stored(_named(rows, keys, total, often), f"names-{level}")
        if old is not None:
            drop_stored(old)
        if most is None:
            most = names.agg(F.max("row_bytes")).head()[0] or 0
        # Texts of one length finish in the same round.
        done.append(names.where(blocks <= 2**level).select(*KEY, "name").distinct())
        if most <= block_bytes * 2**level:
            break
        left = names.where(blocks > 2**level)
        rows = left.groupBy(*KEY, F.shiftright("pos", 1).alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("first"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("second"),
        )
        rows, keys = stored(rows, f"pairs-{level}"), ["first", "second"]
        old, level = rows, level + 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Of equal texts the row with the largest id stays.

    Returns a row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.
    """
    text = whole(text_column)
    texts = docs.select(*row_key(id_column, text), text.alias("text"))
    named = stored(identities(texts, block_bytes), "identities")
    hashed = texts.select(*KEY, F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    # Rows alike in the whole key are numbered, so that one of them can stay.
    copy = F.row_number().over(Window.partitionBy(*KEY).orderBy("text_sha256"))
    rows = stored(hashed.join(named, KEY).withColumn("copy", copy), "named-rows")
    identity = ["row_bytes", "name"]
    groups = rows.groupBy(*identity).agg(F.max("row_id").alias("keep"), F.count("*").alias("group_size"))
    total = rows.count()
    found = with_lookup(rows, groups.withColumn("n", F.col("group_size")), identity, "n", total)

    def given(column: str) -> Column:
        return F.when(F.col(column) != NO_ID, F.col(column))

    return found.select(
        given("row_id").alias("doc_id"),
        given("keep").alias("keep_id"),
        "group_size",
        ((F.col("row_id") == F.col("keep")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )
