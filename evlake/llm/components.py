"""Connected components of a distributed edge list.

Up to ``TASK_EDGES`` edges, counted before, are one task's union-find, which saves the
shuffles. Beyond that, alternating large-star and small-star steps (Kiveris et al., Connected Components in
MapReduce and Beyond): every node ends up linked straight to the smallest node it can
reach. Nothing of the graph is held on the driver, and a node with very many edges is
looked up in a broadcast table of hot nodes.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evlake.llm.common import drop_stored, stored, with_lookup


#: Edges one task may hold, some 100 MB.
TASK_EDGES = 500_000


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["node", "root"]
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())


def components(links: DataFrame) -> DataFrame:
    """``links`` has columns a and b and is stored, as it is read twice; returns node and
    root for every node in them."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    if links.count() <= TASK_EDGES:
        return links.coalesce(1).mapInArrow(_union_find, "node long, root long")
    edges = stored(links.distinct(), "edges")
    mark = _mark(edges)
    if mark[0] <= TASK_EDGES:
        return edges.coalesce(1).mapInArrow(_union_find, "node long, root long")
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"), F.count("*").alias("n"))
        large = with_lookup(both, lowest, ["a"], "n", 2 * mark[0])
        # Neighbours above a node hang on its lowest neighbour.
        starred = stored(large.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "edges")
        total = starred.count()
        lowest = starred.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
        small = with_lookup(starred, lowest, ["a"], "n", total)
        moved = small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        hung = lowest.select("a", F.col("low").alias("b"))
        fresh = stored(moved.unionByName(hung).distinct(), "edges")
        drop_stored(edges)
        drop_stored(starred)
        edges, before, mark = fresh, mark, _mark(fresh)
        if mark == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
