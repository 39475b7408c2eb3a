"""Does the table hold what the topic held? All of it once, some of it twice?"""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evlake.schema import ROW_KEY


def key_balance(expected: DataFrame, table: DataFrame) -> DataFrame:
    """Rows expected and rows present per key.

    Both sides go through one aggregation, which combines copies before the
    shuffle; a key copied many times never meets a join.
    """
    sides = expected.select(*ROW_KEY, F.lit(1).alias("e"), F.lit(0).alias("t")).unionByName(
        table.select(*ROW_KEY, F.lit(0).alias("e"), F.lit(1).alias("t"))
    )
    return sides.groupBy(*ROW_KEY).agg(F.sum("e").alias("expected"), F.sum("t").alias("present"))


def survival(expected: DataFrame, table: DataFrame) -> DataFrame:
    """Published, lost and surplus rows over all keys."""
    balance = key_balance(expected, table)
    return balance.agg(
        F.coalesce(F.sum("expected"), F.lit(0)).alias("published"),
        F.count_if(F.expr("present < expected")).alias("lost"),
        F.coalesce(F.sum(F.greatest(F.lit(0), F.expr("present - expected"))), F.lit(0)).alias(
            "surplus"
        ),
    ).withColumn("all_survived", F.col("lost") == 0)


def range_marks(rows: DataFrame, width: int) -> DataFrame:
    """Rows and an order-free hash of their keys for each topic partition and ``width``
    offsets: two sums, so that equal sets of rows agree in whatever order and batches they
    came, and a lost, surplus or exchanged row shows. Marks of disjoint parts of a table add up."""
    one, two = F.xxhash64(*ROW_KEY), F.xxhash64(F.lit("second"), *ROW_KEY)
    return rows.groupBy(*ROW_KEY[:2], F.floor(F.col("kafka_offset") / width).alias("stretch")).agg(
        F.count("*").alias("n"),
        F.sum(one.cast("decimal(20,0)")).alias("mark"),
        F.sum(two.cast("decimal(20,0)")).alias("mark_2"),
    )


def added_marks(parts: DataFrame) -> DataFrame:
    """Marks of several batches as those of all their rows."""
    place = [*ROW_KEY[:2], "stretch"]
    return parts.groupBy(*place).agg(*[F.sum(c).alias(c) for c in ("n", "mark", "mark_2")])


def differing_stretches(expected: DataFrame, present: DataFrame) -> DataFrame:
    """The stretches whose marks differ, with the rows each side has there. Both sides go
    through one aggregation, a row per stretch each."""
    place = [*ROW_KEY[:2], "stretch"]
    zero = {"n": "long", "mark": "decimal(38,0)", "mark_2": "decimal(38,0)"}
    sides = []
    for df, name in ((expected, "e"), (present, "p")):
        own = [F.col(c).cast(t).alias(f"{name}_{c}") for c, t in zero.items()]
        other = [F.lit(0).cast(t).alias(f"{'p' if name == 'e' else 'e'}_{c}") for c, t in zero.items()]
        sides.append(df.select(*place, *own, *other))
    both = sides[0].unionByName(sides[1]).groupBy(*place)
    both = both.agg(*[F.sum(f"{s}_{c}").alias(f"{s}_{c}") for s in "ep" for c in zero])
    differ = F.col("e_n") != F.col("p_n")
    for c in ("mark", "mark_2"):
        differ |= F.col(f"e_{c}") != F.col(f"p_{c}")
    return both.where(differ).select(*place, F.col("e_n").alias("expected"), F.col("p_n").alias("present"))


def survival_by_stretch(expected: DataFrame, table: DataFrame, width: int, marks: tuple | None = None) -> DataFrame:
    """:func:`key_balance` of the stretches that differ, and of no other row.

    ``marks`` are both sides' marks where they are kept batch by batch; else they are
    taken here.
    """
    expected_marks, present_marks = marks or (range_marks(expected, width), range_marks(table, width))
    place = [*ROW_KEY[:2], "stretch"]
    differing = differing_stretches(expected_marks, present_marks).select(*place)
    same = [F.col(f"rows.{c}").eqNullSafe(F.col(f"differing.{c}")) for c in place]

    def inside(df: DataFrame) -> DataFrame:
        placed = df.select(*ROW_KEY).withColumn("stretch", F.floor(F.col("kafka_offset") / width))
        return placed.alias("rows").join(differing.alias("differing"), same, "left_semi").drop("stretch")

    return key_balance(inside(expected), inside(table))


def lost_rows(expected: DataFrame, table: DataFrame) -> DataFrame:
    return key_balance(expected, table).where("present < expected").select(*ROW_KEY)


def growth(before: DataFrame, after: DataFrame, expected: DataFrame) -> DataFrame:
    """Did the table grow by exactly the expected rows?"""
    parts = [
        df.select(*[F.lit(int(i == j)).alias(n) for j, n in enumerate(("b", "a", "e"))])
        for i, df in enumerate((before, after, expected))
    ]
    sums = parts[0].unionAll(parts[1]).unionAll(parts[2]).agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("rows_after"),
        F.coalesce(F.sum("e"), F.lit(0)).alias("expected"),
    )
    return sums.withColumn("gained", F.expr("rows_after - rows_before")).withColumn(
        "exact", F.expr("gained = expected")
    )


def batching_holds(commits_before: DataFrame, commits_after: DataFrame, rows_gained: DataFrame) -> DataFrame:
    """New commits exist, and fewer than the rows they brought."""
    g = growth(commits_before, commits_after, rows_gained)
    return g.select(
        F.col("gained").alias("new_commits"),
        F.col("expected").alias("rows_gained"),
        F.expr("gained > 0 and gained < expected").alias("batched"),
    )


def acknowledged(messages: DataFrame, committed: DataFrame) -> DataFrame:
    """Committed against published offsets per partition. ``committed`` has the columns
    of :func:`evlake.operators.offsets.next_offsets`; the table's log has them."""
    published = messages.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("published"))
    done = committed.select(
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("next_offset").alias("committed"),
    )
    return published.join(done, ["topic", "partition"], "left").withColumn(
        "complete", F.coalesce(F.col("committed") == F.col("published"), F.lit(False))
    )


def separate_buckets(watched: str, warehouse: str) -> None:
    """Refuse a warehouse inside the watched bucket: it would feed itself."""
    ours, theirs = (_BUCKET.match(uri.strip()) for uri in (watched, warehouse))
    if ours and theirs and ours[1] == theirs[1]:
        raise ValueError(f"the table {warehouse} must not be stored in the watched bucket")


_BUCKET = re.compile(r"s3a?://([^/]+)")
