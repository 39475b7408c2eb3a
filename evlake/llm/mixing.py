"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the schedule takes the point frac(i * golden ratio) and maps it through the
sources' cumulative target shares; the slots of a source are ranked. Every source's
documents are shuffled by a hash and laid end to end, as often as the source repeats,
and cut into blocks of as many tokens as a slot stands for; the slot of rank r takes
the source's block r. A document belongs to the block its middle token falls into.

The schedule is a table of numbers made by Spark. Ranks and places come from chunk
totals plus a window inside each chunk or bucket, so a source that holds most of the
input is never one task's work. Everything is DataFrame functions.

Documents longer than a ``LARGE``-th part of what their source's last, partial pass
takes are put where that pass does not cut: first in the order where all of them fit
in, else last. So what a source gives misses its target by a short document at most,
unless the source consists of long ones.

Defined results: a null text and a blank one have no tokens, are taken no words of
and shift nothing; a null source is a source, the last; rows repeated in full are
documents of their own. An empty table gives an empty mix. Reruns agree: nothing
depends on partitions or arrival.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evlake.llm.common import NO_ID, stored, whole

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
#: Slots per document; more make the schedule finer.
SLOTS_PER_DOCUMENT = 8
CHUNK_SLOTS = 1 << 14
BUCKET_DOCUMENTS = 4096
LARGE = 32
#: Fractional part of the golden ratio, to 40 bits: products with a slot's number are
#: exact in 128-bit decimals.
GOLDEN_40 = 679534170663


def token_count(text: str) -> Column:
    """Words, runs of anything but space and the ASCII controls 9 to 13."""
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def target_sizes(sizes: list[int], weights: list[float], most: float = MOST_REPEATS) -> list[float]:
    """Share the sum of ``sizes`` by weight, none above ``most`` times its own; what is
    above goes to the others by weight until none is."""
    targets, open_ = [0.0] * len(sizes), {i for i, s in enumerate(sizes)}
    left = float(sum(sizes))
    while open_:
        all_weights = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] / all_weights > most * sizes[i]}
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / all_weights
            break
        for i in full:
            targets[i] = float(most * sizes[i])
        open_ -= full
        left = sum(sizes) - sum(targets)
    return targets


def _sources(docs: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """A row per source in order: its size and target. Sources are few by nature; the
    driver sees one row of each, never a document."""
    rows = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents")).collect()
    # Strings compare by code point here.
    rows.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r.source_size for r in rows]
    targets = target_sizes(sizes, [float(weights[i % len(weights)]) for i in range(len(rows))])
    made = [(i, r.source, s, t, r.documents) for i, (r, s, t) in enumerate(zip(rows, sizes, targets, strict=True))]
    return docs.sparkSession.createDataFrame(
        made, "source_no int, source string, source_size long, target double, documents long"
    )


def _schedule(spark, targets: list[float], slots: int) -> DataFrame:
    """source_no and rank of every slot, from one chunk total per chunk and source."""
    whole_sum = sum(targets)
    cuts, so_far = [], 0.0
    for t in targets[:-1]:
        so_far += t
        cuts.append(so_far / whole_sum)
    point = F.pmod(F.col("slot").cast("decimal(20,0)") * F.lit(GOLDEN_40), F.lit(1 << 40)).cast("double") / float(1 << 40)
    place = F.aggregate(F.array(*[F.lit(c) for c in cuts]), F.lit(0), lambda n, c: n + (F.col("point") >= c).cast("int"))
    source = place if cuts else F.lit(0)
    rows = (
        spark.range(slots)
        .withColumnRenamed("id", "slot")
        .withColumn("point", point)
        .select("slot", F.floor(F.col("slot") / CHUNK_SLOTS).alias("chunk"), source.alias("source_no"))
    )
    totals = rows.groupBy("source_no", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("source_no", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")) - 1
    return rows.withColumn("inside", inside).join(offsets, ["source_no", "chunk"]).select(
        "slot", "source_no", (F.col("offset") + F.col("inside")).alias("rank")
    )


def _laid_out(docs: DataFrame, sources: DataFrame, total_documents: int) -> DataFrame:
    """Every document with the tokens of its source before it, in shuffled order."""
    known = docs.join(F.broadcast(sources), docs["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    passes = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    rest = F.col("target") - passes * F.col("source_size")
    known = known.withColumn("rest", rest).withColumn("large", F.col("size") * LARGE > F.col("rest"))
    large = known.groupBy("source_no").agg(F.sum(F.when(F.col("large"), F.col("size")).otherwise(0)).alias("large_size"))
    known = known.join(F.broadcast(large), "source_no")
    first = F.col("large_size") <= F.col("rest")
    turn = F.when(F.col("large") == first, 0).otherwise(1)
    buckets = max(1, total_documents // BUCKET_DOCUMENTS)
    order = F.xxhash64(F.lit("mix"), "row_id", "row_hash")
    known = stored(
        known.withColumn("turn", turn).withColumn("order", order)
        # Buckets are ranges of the hash, so their order is that of the documents.
        .withColumn("bucket", F.floor((F.shiftrightunsigned("order", 1)) / float(2**63) * buckets))
        .select("row_id", "row_hash", "row", "size", "source_no", "source_size", "target", "turn", "order", "bucket"),
        "mix-documents",
    )
    totals = known.groupBy("source_no", "turn", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source_no").orderBy("turn", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("source_no", "turn", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_no", "turn", "bucket").orderBy(
        F.shiftrightunsigned("order", 1), "row_id", "row_hash", "row"
    ).rowsBetween(Window.unboundedPreceding, -1)
    return known.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, ["source_no", "turn", "bucket"]
    ).withColumn("start", F.col("offset") + F.col("inside"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The documents with their sizes, and the mix.

    The first has a row per row of ``docs`` (doc_id, row_hash, size, source_size,
    target, taken); the second a row per document and slot it was taken for (slot,
    doc_id, row_hash, source_no, pass), to be read in order of slots.
    """
    spark = docs.sparkSession
    text = whole(text_column)
    # Rows alike in id and text are told apart by a number among themselves only.
    key = [F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("row_id"), F.xxhash64(text).alias("row_hash")]
    sized = docs.select(*key, F.col(source_column).cast("string").alias("source"), token_count(text_column).alias("size"))
    alike = Window.partitionBy("row_id", "row_hash").orderBy("source")
    sized = stored(sized.withColumn("row", F.row_number().over(alike)), "mix-sizes")
    sources = _sources(sized, weights)
    facts = sources.collect()
    total, count = sum(r.source_size for r in facts), sum(r.documents for r in facts)
    slots = SLOTS_PER_DOCUMENT * count
    if not total:
        nothing = F.lit(0).cast("long")
        rows = sized.select(_given().alias("doc_id"), "row_hash", "size", nothing.alias("source_size"),
                            F.lit(0.0).alias("target"), nothing.alias("taken"))
        return rows, spark.createDataFrame([], "slot long, doc_id long, row_hash long, source_no int, pass int")
    block = total / slots
    schedule = _schedule(spark, [r.target for r in facts], slots)
    # The schedule's slots per source are known without counting: the last rank.
    laid = _laid_out(sized, sources, count)
    middle = F.col("start") + F.col("size") / 2 + F.col("pass") * F.col("source_size")
    wanted = (
        laid.where("size > 0")
        .withColumn("pass", F.explode(F.array(*[F.lit(i) for i in range(math.ceil(MOST_REPEATS))])))
        .withColumn("rank", F.floor(middle / block))
        # Nothing so late can be reached by the schedule.
        .where(F.col("rank") <= F.ceil(F.col("target") / block * 1.05) + 64)
    )
    taken = stored(
        wanted.join(schedule, ["source_no", "rank"]).select("slot", "row_id", "row_hash", "row", "source_no", "pass"),
        "mix",
    )
    times = taken.groupBy("row_id", "row_hash", "row").agg(F.count("*").alias("times"))
    rows = laid.join(times, ["row_id", "row_hash", "row"], "left").select(
        _given().alias("doc_id"), "row_hash", "size", "source_size", "target",
        (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken"),
    )
    return rows, taken.select("slot", _given().alias("doc_id"), "row_hash", "source_no", "pass")


def _given() -> Column:
    return F.when(F.col("row_id") != NO_ID, F.col("row_id"))
