"""Near-duplicate vectors by sorted projection passes.

A pass hashes every vector with ``HASHES`` random cross-polytope hashes (turn at random,
name the coordinate of the largest size and its sign), concatenates them and sorts the
vectors by the result, so that similar vectors, which share a beginning, come close. In
that order each is compared with the ``WINDOW`` vectors after it. Passes have random
turns of their own. A pair just at 0.95 in 64 dimensions shares a hash with probability
0.6, so among n vectors a pass finds it with about 0.6^log128(n / WINDOW): 0.42 of a
million, 0.2 of 10^9, of which ``PASSES`` passes miss 0.2 % and 7 %; closer pairs are
missed far less. The links found, as one tree per block of the order, are united to
components across all passes.

Links are then counted inside the components, so a pair counts once however many passes
found it, and a group larger than a window is whole all the same. Where every two of
some vectors must be linked because all are within half the angle of the group's mean,
nothing is compared: that is what makes a large group of copies cheap. Only the other
members, the rim, are compared with the whole component, in tiles.

The order is global: every vector gets its rank from sorted partitions and their
totals, and a block of ranks is a task's unit, with the beginning of the next block. So
equal or very similar vectors, however many, are spread over blocks of one size.

Defined results: vectors that are null or empty, have a component that is null or not
finite, or are zero, are linked with nothing, and so are vectors of different lengths. A
null id is no group's smallest unless all its ids are null. Rows repeated in full and
rows sharing an id are vectors of their own. An empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evlake.llm.common import stored, with_lookup
from evlake.llm.components import components
from evlake.llm.vectors import lists_of

PASSES = 12
#: Hashes of a pass, and axes each chooses from: 128^8 keys, which fit 63 bits.
HASHES = 8
AXES = 64
#: Vectors after it that each is compared with, and vectors of a block.
WINDOW = 256
BLOCK = 1024
#: Components of up to so many vectors are counted together, in groups of about as many
#: vectors; larger ones in tiles of ``TILE`` vectors a side.
SMALL = 256
TILE = 1024
#: What rounding may add to a cosine, many times over.
ROUNDING = 1e-12


def unit_rows(values: np.ndarray, ends: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """The given lists, all of ``width`` components, at length 1; unusable ones as zeros."""
    x = values[ends[rows][:, None] + np.arange(width)]
    x = np.where(np.isfinite(x).all(1, keepdims=True), x, 0)
    # Without passing the largest or smallest double on the way.
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), np.finfo(float).tiny)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def _widths(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and unit vectors for each length there is; null lists are of length 0."""
    values, ends, _ = lists_of(column)
    length = np.diff(ends)
    for width in np.unique(length):
        rows = np.flatnonzero(length == width)
        if width:
            yield rows, unit_rows(values, ends, rows, int(width))


def _turns(width: int, number: int) -> np.ndarray:
    """Random turns of a pass, one for each hash; of wide vectors into ``AXES`` axes."""
    random = np.random.default_rng((20260109, width, number))
    return np.stack([np.linalg.qr(random.normal(size=(width, min(width, AXES))))[0] for _ in range(HASHES)])


def hashes_of(unit: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """The concatenated hashes of unit vectors as one number each, the first in front."""
    key = np.zeros(len(unit), np.int64)
    for turn in turns:
        turned = unit @ turn
        largest = np.abs(turned).argmax(1)
        negative = turned[np.arange(len(unit)), largest] < 0
        key = key * (2 * turn.shape[1]) + 2 * largest + negative
    return key


def _keys(passes: int):
    """A row per vector and pass; vectors that link with nothing have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = {}
        for batch in batches:
            own = batch.column("row").to_numpy()
            for rows, unit in _widths(batch.column("vector")):
                width = unit.shape[1]
                some = (unit != 0).any(1)
                rows, unit = rows[some], unit[some]
                for number in range(passes):
                    if (width, number) not in turns:
                        turns[width, number] = _turns(width, number)
                    keys = hashes_of(unit, turns[width, number])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), number, np.int32)),
                            pa.array(np.full(len(rows), width, np.int32)),
                            pa.array(keys),
                            pa.array(own[rows]),
                        ],
                        ["pass", "width", "key", "row"],
                    )

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass and row with their place in the partition."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        place = pa.array(np.arange(before, before + n))
        columns = [batch.column("pass"), batch.column("row"), pa.array(np.full(n, part, np.int32)), place]
        yield pa.RecordBatch.from_arrays(columns, ["pass", "row", "part", "place"])
        before += n


def ranks(keys: DataFrame) -> DataFrame:
    """Pass, row and the row's place in the order of all keys."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["pass", "width", "key", "row"]
    ranged = keys.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stored(ranged.mapInArrow(_numbered, "pass int, row long, part int, place long"), "places")
    # One row per partition is put in one order.
    ends = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return placed.join(F.broadcast(offsets), "part").select(
        "pass", "row", (F.col("offset") + F.col("place")).alias("rank")
    )


def _join_up(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the linked pairs: every root becomes the least of its group."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root[:] = root[root]


def _window_links(least: float):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("pass", "ascending"), ("rank", "ascending")])
        own, number, rank = (rows.column(c).to_numpy() for c in ("row", "pass", "rank"))
        first = ~rows.column("beyond").to_numpy(zero_copy_only=False)
        root = np.arange(len(own))
        for at, unit in _widths(rows.column("vector").combine_chunks()):
            # Of one width and in the order of their ranks.
            for start in range(0, len(at), WINDOW):
                left, right = at[start : start + WINDOW], at[start : start + 2 * WINDOW]
                cosine = unit[start : start + WINDOW] @ unit[start : start + 2 * WINDOW].T
                i, j = np.nonzero(cosine >= least)
                a, b = left[i], right[j]
                gap = rank[b] - rank[a]
                near = (number[a] == number[b]) & (gap > 0) & (gap <= WINDOW) & first[a]
                _join_up(root, a[near], b[near])
        linked = np.flatnonzero(root != np.arange(len(own)))
        return pa.table([pa.array(own[linked]), pa.array(own[root[linked]])], names=["a", "b"])

    return run


def links(vectors: DataFrame, least: float, passes: int = PASSES) -> DataFrame:
    """Links (a, b) that unite whatever the windows of all passes found, for vectors
    with the columns row and vector."""
    keys = vectors.mapInArrow(_keys(passes), "pass int, width int, key long, row long")
    block = F.floor(F.col("rank") / BLOCK)
    # The beginning of a block is the end of the window of the one before.
    beyond = (F.col("rank") % BLOCK < WINDOW) & (F.col("rank") >= BLOCK)
    blocks = F.when(beyond, F.array(block, block - 1)).otherwise(F.array(block))
    dealt = ranks(keys).select("pass", "row", "rank", F.explode(blocks).alias("block"))
    dealt = dealt.withColumn("beyond", F.col("block") != block).join(vectors, "row")
    return stored(dealt.groupBy("block").applyInArrow(_window_links(least), "a long, b long"), "window-links")


def _count_small(least: float):
    """Links inside components, all of which are whole here."""

    def run(rows: pa.Table) -> pa.Table:
        own, root = rows.column("row").to_numpy(), rows.column("root").to_numpy()
        count = np.zeros(len(own), np.int64)
        for at, unit in _widths(rows.column("vector").combine_chunks()):
            order = np.argsort(root[at], kind="stable")
            ends = np.flatnonzero(np.diff(root[at][order], prepend=-1, append=-1))
            for start, end in zip(ends[:-1], ends[1:], strict=True):
                group = order[start:end]
                count[at[group]] = (unit[group] @ unit[group].T >= least).sum(1)
        return pa.table([pa.array(own), pa.array(count - 1)], names=["row", "n"])

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the unit vectors of each component, per task."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        roots = batch.column("root").to_numpy()
        for at, unit in _widths(batch.column("vector")):
            for root in np.unique(roots[at]):
                total[root] = total.get(root, 0) + unit[roots[at] == root].sum(0)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int64()), pa.array([t.tolist() for t in total.values()], pa.list_(pa.float64()))],
        ["root", "total"],
    )


def _centre(rows: pa.Table) -> pa.Table:
    total = np.sum(rows.column("total").to_pylist(), axis=0)
    return pa.table([rows.column("root")[:1], pa.array([total.tolist()])], names=["root", "centre"])


def _in_core(least: float):
    """Whether a member lies within half the angle of its component's centre."""
    near = np.sqrt((1 + least) / 2) + ROUNDING

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core = np.zeros(batch.num_rows, bool)
            # A component has one length, so both columns fall into the same parts.
            parts = zip(_widths(batch.column("vector")), _widths(batch.column("centre")), strict=True)
            for (at, unit), (_, centre) in parts:
                core[at] = (unit * centre).sum(1) >= near
            columns = [batch.column(c) for c in ("row", "root", "n_rows", "vector")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(core)], ["row", "root", "n_rows", "vector", "core"])

    return run


def _count_tile(least: float):
    """Links between the rim members of one tile and the members of another."""

    def run(rows: pa.Table) -> pa.Table:
        own = rows.column("row").to_numpy()
        asks, core = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "core"))
        count = np.zeros(len(own), np.int64)
        for at, unit in _widths(rows.column("vector").combine_chunks()):
            rim, all_of = np.flatnonzero(asks[at]), np.flatnonzero(~asks[at])
            linked = (unit[rim] @ unit[all_of].T >= least) & (own[at][rim][:, None] != own[at][all_of])
            count[at[rim]] += linked.sum(1)
            # A core member does not ask by itself.
            count[at[all_of]] += linked.sum(0) * core[at][all_of]
        return pa.table([pa.array(own), pa.array(count)], names=["row", "n"])

    return run


def _count_large(members: DataFrame, least: float, total: int) -> DataFrame:
    """Links of the members of components too large to be in one place."""
    sums = members.mapInArrow(_sums, "root long, total array<double>")
    centres = sums.groupBy("root").applyInArrow(_centre, "root long, centre array<double>")
    sized = members.groupBy("root").agg(F.count("*").alias("n"))
    known = with_lookup(members, centres.join(sized, "root").withColumn("n_rows", F.col("n")), ["root"], "n", total)
    known = known.select("row", "root", "n_rows", "vector", "centre")
    kind = members.schema["vector"].dataType.simpleString()
    kinds = f"row long, root long, n_rows long, vector {kind}, core boolean"
    kinds = stored(known.mapInArrow(_in_core(least), kinds), "core")
    cores = kinds.groupBy("root").agg(F.count_if("core").alias("n_core"), F.count("*").alias("n"), F.max("n_rows").alias("m"))
    counted = with_lookup(kinds.drop("vector"), cores.drop("m"), ["root"], "n", total)
    inside = counted.select("row", F.when(F.col("core"), F.col("n_core") - 1).otherwise(F.lit(0)).alias("n"))
    # A rim tile meets every tile of its component.
    rims = cores.where("n_core < n").select(
        "root", "n", F.ceil((F.col("n") - F.col("n_core")) / TILE).alias("rims"), F.ceil(F.col("n") / TILE).alias("tiles")
    )
    open_rows = with_lookup(kinds, rims, ["root"], "n", total)
    spread = F.xxhash64("row")
    asking = open_rows.where("not core").select(
        "root", "row", "vector", "core", F.lit(True).alias("asks"), F.pmod(spread, F.col("rims")).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("j"),
    )
    asked = open_rows.select(
        "root", "row", "vector", "core", F.lit(False).alias("asks"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("rims") - 1)).alias("i"),
        F.pmod(spread, F.col("tiles")).alias("j"),
    )
    tiles = asking.unionByName(asked).groupBy("root", "i", "j").applyInArrow(_count_tile(least), "row long, n long")
    return inside.unionByName(tiles).groupBy("row").agg(F.sum("n").alias("n"))


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    least: float = 0.95,
    passes: int = PASSES,
) -> DataFrame:
    """A row per row of ``vectors``: vec_id, n_links (other vectors with a cosine of at
    least ``least``), component_id and kept."""
    # Floats travel as floats; cosines are taken of doubles all the same.
    kind = "array<float>" if vectors.schema[vector_column].dataType == T.ArrayType(T.FloatType()) else "array<double>"
    own = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast(kind).alias("vector"),
    )
    own = stored(own, "vectors")
    nodes = stored(components(links(own.select("row", "vector"), least, passes)), "vector-components")
    sizes = nodes.groupBy("root").agg(F.count("*").alias("n"))
    total = nodes.count()
    grouped = with_lookup(nodes, sizes.withColumn("size", F.col("n")), ["root"], "n", total)
    members = stored(grouped.join(own.withColumnRenamed("row", "node"), "node").withColumnRenamed("node", "row"), "members")

    small = members.where(F.col("size") <= SMALL)
    bucket = F.pmod(F.xxhash64("root"), F.lit(max(total // SMALL, 1)))
    counts = small.select("row", "root", "vector", bucket.alias("bucket")).groupBy("bucket")
    counts = counts.applyInArrow(_count_small(least), "row long, n long")
    large = members.where(F.col("size") > SMALL).select("row", "root", "vector")
    if not large.isEmpty():
        counts = counts.unionByName(_count_large(large, least, total))

    lowest = members.groupBy("root").agg(F.min("vec_id").alias("component_id"), F.count("*").alias("n"))
    named = with_lookup(members.select("row", "root"), lowest, ["root"], "n", total)
    linked = own.select("row", "vec_id").join(named.select("row", "component_id", F.lit(True).alias("__in")), "row", "left")
    component = F.when(F.col("__in"), F.col("component_id")).otherwise(F.col("vec_id"))
    return linked.join(counts, "row", "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
