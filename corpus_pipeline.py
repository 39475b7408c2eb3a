"""A corpus from raw documents to balanced shards, in five stages.

Each stage is ``function(spark, docs, sf_dir)``; its result is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of
``documents``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evlake.llm.common import KEY, row_key, stored, table, whole, with_maybe
from evlake.llm.decontaminate import without_leaks
from evlake.llm.mixing import mix
from evlake.llm.near_dedup import BROADCAST_ROWS, near_duplicates
from evlake.llm.sharding import shards
from evlake.llm.toxicity import fit, without_toxic

#: Label columns in the order of the classifier chain; the last decides.
CHAIN = ["quality", "toxic"]

#: The toxicity model and the near-duplicate groups cannot be told in SQL, so the tests
#: hold the stages against brute-force versions.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents rejected as toxic go."""
    return without_toxic(docs, fit(docs, table(spark, sf_dir, "labels"), CHAIN))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the document with the
    smallest id stays (a null id comes last; then by its text); of rows repeated in full,
    one. Texts without words are no group and stay."""
    groups = near_duplicates(docs, shingle_words=5, percent=80)
    each = groups.groupBy(*KEY).agg(F.count("*").alias("rows"), F.max("first").alias("first"))
    # Most rows stay as they are; only those that may be others' copies are joined.
    special = stored(each.where(~F.col("first") | (F.col("rows") > 1)), "special")
    source = docs.select(*docs.columns, *[k.alias(f"__{n}") for k, n in zip(row_key("doc_id", whole("text")), KEY, strict=True)])
    names, plain, few = [f"__{n}" for n in KEY], None, special.count() <= BROADCAST_ROWS
    if not few:
        marked = with_maybe(source, "__row_hash", special, "row_hash", "__special")
        plain, source = marked.where("not __special"), marked.where("__special")

    def of(rows: DataFrame, how: str) -> DataFrame:
        rows = rows.select(*[F.col(n).alias(f"__{n}") for n in KEY])
        return source.join(F.broadcast(rows) if few else rows, names, how)

    found, repeated = of(special, "left_anti"), special.where("first")
    if plain is not None:
        found = found.unionByName(plain)
    if not repeated.isEmpty():
        found = found.unionByName(of(repeated, "left_semi").dropDuplicates(names))
    return found.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, up to three times; documents of
    sources above their share go in part. A null id or text is a value like others; rows
    alike in id and text are taken equally often."""
    _, taken = mix(docs)
    times = taken.groupBy("doc_id", "row_hash").agg(F.count("*").alias("__times"))
    key = F.xxhash64(whole("text"))
    held = times.select(F.col("doc_id").alias("__id"), F.col("row_hash").alias("__hash"), "__times")
    # Rows alike in id and text share what their key is taken for.
    alike = docs.groupBy(F.col("doc_id").alias("__id"), key.alias("__hash")).agg(F.count("*").alias("__alike"))
    each = held.join(alike, held["__id"].eqNullSafe(alike["__id"]) & (held["__hash"] == alike["__hash"])).select(
        held["__id"], held["__hash"], F.ceil(F.col("__times") / F.col("__alike")).cast("int").alias("__times")
    )
    each = each.select("__id", "__hash", F.explode(F.array_repeat(F.lit(1), F.col("__times"))))
    same = docs["doc_id"].eqNullSafe(each["__id"]) & (key == each["__hash"])
    return docs.join(each, same).select(*[docs[c] for c in docs.columns])


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document in sixteen contiguous shards of equal bytes."""
    return shards(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
