"""What several of the training-data operators need: stored tables, joins that
survive a hot key, and a row's own key."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evlake.session import configure, new_folder

#: A key is hot when it has over one in so many rows. There are at most that many
#: hot keys, so a table of them may be broadcast whatever the size of the input.
HOT_PART = 1000

#: Words of 64 bits in a table that tells which keys may be wanted, some 10 MB.
FILTER_WORDS = 1 << 18

#: Stands for a null id in keys.
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written below the shared folder and read again.

    This cuts the lineage and fixes what was computed, so a lost executor costs a
    reread and never a second, different answer.
    """
    spark = df.sparkSession
    path = new_folder(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def with_lookup(left: DataFrame, right: DataFrame, keys: list[str], rows: str, total: int, small: int = 0) -> DataFrame:
    """Inner join of ``left`` with the rows of ``right``, one per key.

    ``rows`` names the column of ``right`` that says how many rows of ``left`` have
    the key, ``total`` is their sum. Hot keys, if there are any, are looked up in a
    broadcast table of at most ``HOT_PART`` rows and never shuffled; the others are
    joined on the key. A table ``right`` of up to ``small`` rows is broadcast whole.
    """
    right = stored(right, "lookup")
    if small and right.count() <= small:
        return left.join(F.broadcast(right.drop(rows)), keys)
    hot = F.col(rows) * HOT_PART > total
    few, many = right.where(hot).drop(rows), right.where(~hot).drop(rows)
    if few.isEmpty():
        return left.join(many, keys)
    at_hot = left.join(F.broadcast(few), keys)
    rest = left.join(F.broadcast(few.select(*keys)), keys, "left_anti")
    return at_hot.unionByName(rest.join(many, keys))


def with_maybe(rows: DataFrame, hashed: str, keys: DataFrame, key: str, name: str) -> DataFrame:
    """The rows with a column ``name``: whether their hash may be among the ``keys``, true
    for all that are and, by a broadcast table of bits of a fixed size, for few others."""

    def bit(column: str) -> tuple[Column, Column]:
        at = F.col(column).bitwiseAND(F.lit(64 * FILTER_WORDS - 1))
        return F.shiftright(at, 6), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))

    word, mask = bit(key)
    words = stored(keys.groupBy(word.alias("__word")).agg(F.bit_or(mask).alias("__bits")), "filter")
    word, mask = bit(hashed)
    found = rows.join(F.broadcast(words), word == F.col("__word"), "left")
    held = F.coalesce(F.col("__bits").bitwiseAND(mask) != 0, F.lit(False))
    return found.select(*[rows[c] for c in rows.columns], held.alias(name))


def row_key(id_column: str, text: Column) -> list[Column]:
    """Columns that tell the rows of a table apart: the id, and for repeated ids the
    text's hash and byte length. Rows alike in all three are copies of one row."""
    return [
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("row_id"),
        F.xxhash64(text).alias("row_hash"),
        F.octet_length(text).cast("long").alias("row_bytes"),
    ]


KEY = ["row_id", "row_hash", "row_bytes"]


def whole(text: str) -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
