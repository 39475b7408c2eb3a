"""Centroid clustering in integers, with PCA-rotated filtering.

Vectors become integers, floor(scale * x), so that sums, centroids and distances are
exact and do not depend on how Spark deals the rows out. One pass over all vectors sums
up their products, 64 x 64 numbers, whose eigenvectors are the rotation. Each vector is
stored with its ``LEADING`` first rotated coordinates and the norm of the rest.

Between a vector and a centroid, the squared distance of the leading coordinates plus
the squared difference of the residual norms never exceeds the squared distance. The
centroid of the least such bound is measured first, in integers; those whose bound lies
above that distance are out, and the others, the survivors, are measured in integers
too. The bounds carry an allowance for rounding, so the result is that of measuring
every centroid.

A round gives one row of sums per task and cluster, added up by Spark; only the
centroids, ``k`` of them, pass the driver. Rounds end early when no centroid moves,
since all later ones would be alike.

Defined results: vectors that are null, of another length, or with a component that is
null or not finite are left out. Equal vectors take the same cluster; ties go to the
smaller number. Rows repeated in full are rows of their own; rows without an id are
clustered, but start no cluster unless there are too few others. With fewer than ``k``
vectors there are as many clusters; an empty table has none. Integers beyond
``LARGEST``, whose squared distances might pass 64 bits, are an error.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evlake.llm.common import stored
from evlake.llm.vectors import whole_vectors

LEADING = 16
#: Squared distances of 64 differences of twice this stay below 2^63.
LARGEST = 2**27
#: Share of the squared norms that rounding may take from a bound, many times over.
ROUNDING = 1e-9


@dataclass(frozen=True)
class Clusters:
    """``rows``: id, cluster and distance of every vector; ``centroids``: the final ones."""

    rows: DataFrame
    centroids: list[list[int]]

    def with_totals(self) -> DataFrame:
        """The rows with their cluster's and the whole inertia and a hash of their
        centroid."""
        # One row per cluster.
        sums = self.rows.groupBy("cluster").agg(F.sum("distance").alias("sum")).collect()
        inertia = dict.fromkeys(range(len(self.centroids)), 0) | {r["cluster"]: r["sum"] for r in sums}
        digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids]

        def of_cluster(values: list, kind: str):
            return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")[F.col("cluster")]

        return self.rows.select(
            "*",
            of_cluster([inertia[i] for i in range(len(digests))], "long").alias("cluster_inertia"),
            F.lit(sum(inertia.values())).cast("long").alias("inertia"),
            of_cluster(digests, "string").alias("centroid_sha256"),
        )


def _integers(vector_column: str, width: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, matrix = whole_vectors(batch.column(vector_column), width)
            whole = np.floor(matrix * scale)
            if (np.abs(whole) > LARGEST).any():
                raise ValueError(f"a component times {scale} exceeds {LARGEST}")
            flat = pa.array(whole.astype(np.int64).reshape(-1))
            ends = pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32))
            ids = batch.column("id").take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(ends, flat)], ["id", "vector"])

    return run


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, width)


def _products(width: int):
    """Count, sums and products of a task's vectors, as rows (place, value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            x = np.column_stack((_matrix(batch, width).astype(np.float64), np.ones(batch.num_rows)))
            total += x.T @ x
        place = np.flatnonzero(np.triu(np.ones_like(total)).reshape(-1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(place.astype(np.int32)), pa.array(total.reshape(-1)[place])], ["place", "value"]
        )

    return run


def rotation(integers: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and eigenvectors of the covariance (columns, the largest first)."""
    sums = integers.mapInArrow(_products(width), "place int, value double").groupBy("place").agg(F.sum("value"))
    total = np.zeros((width + 1) ** 2)
    for place, value in sums.collect():  # width^2 / 2 numbers
        total[place] = value
    total = total.reshape(width + 1, width + 1)
    total = np.triu(total) + np.triu(total, 1).T
    count = max(total[-1, -1], 1)
    mean = total[-1, :-1] / count
    _, vectors = np.linalg.eigh(total[:-1, :-1] / count - np.outer(mean, mean))
    return mean, vectors[:, ::-1]


def _rotated(matrix: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    turned = (matrix - mean) @ axes
    return turned[:, :leading], np.linalg.norm(turned[:, leading:], axis=1)


def _with_rotation(mean: np.ndarray, axes: np.ndarray, leading: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head, rest = _rotated(_matrix(batch, len(mean)), mean, axes, leading)
            ends = pa.array(np.arange(0, head.size + 1, leading, dtype=np.int32))
            columns = [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(head.reshape(-1))), pa.array(rest)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "head", "rest"])

    return run


def nearest(
    x: np.ndarray, head: np.ndarray, rest: np.ndarray, c: np.ndarray, c_head: np.ndarray, c_rest: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid, in integers."""
    bound = ((head[:, None] - c_head) ** 2).sum(-1) + (rest[:, None] - c_rest) ** 2
    norms = (head**2).sum(-1) + rest**2
    bound -= ROUNDING * (norms[:, None] + (c_head**2).sum(-1) + c_rest**2 + 1)
    best = bound.argmin(1)
    distance = ((x - c[best]) ** 2).sum(-1)
    bound[np.arange(len(x)), best] = np.inf
    for j in range(len(c)):
        survives = np.flatnonzero(bound[:, j] <= distance)
        measured = ((x[survives] - c[j]) ** 2).sum(-1)
        closer = (measured < distance[survives]) | ((measured == distance[survives]) & (j < best[survives]))
        at = survives[closer]
        best[at], distance[at] = j, measured[closer]
    return best, distance


def _assigned(mean: np.ndarray, axes: np.ndarray, leading: int, centroids: np.ndarray):
    c_head, c_rest = _rotated(centroids, mean, axes, leading)

    def each(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                head = batch.column("head").flatten().to_numpy().reshape(-1, leading)
                x = _matrix(batch, len(mean))
                yield batch, x, *nearest(x, head, batch.column("rest").to_numpy(), centroids, c_head, c_rest)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros(centroids.shape, np.int64)
        for _, x, cluster, _ in each(batches):
            count += np.bincount(cluster, minlength=len(count))
            for j in range(len(count)):
                total[j] += x[cluster == j].sum(0)
        ends = pa.array(np.arange(0, total.size + 1, total.shape[1], dtype=np.int32))
        numbers = pa.array(np.arange(len(count), dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [numbers, pa.array(count), pa.ListArray.from_arrays(ends, pa.array(total.reshape(-1)))],
            ["cluster", "rows", "total"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, cluster, distance in each(batches):
            columns = [batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

    return sums, rows


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    width: int = 64,
    k: int = 8,
    rounds: int = 10,
    seed: int = 3,
    scale: int = 1024,
    leading: int = LEADING,
) -> Clusters:
    """Clusters of the vectors with ``width`` components after ``rounds`` rounds. The
    vectors whose ids with ``seed`` have the smallest hashes are the first centroids."""
    given = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("given"))
    integers = stored(given.mapInArrow(_integers("given", width, scale), "id long, vector array<long>"), "integers")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = integers.orderBy(F.asc_nulls_last(hashed), "vector").limit(k)
    centroids = np.array([r.vector for r in first.select("vector").collect()], np.int64).reshape(-1, width)
    leading = min(leading, width)
    if not len(centroids):
        return Clusters(integers.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [])
    mean, axes = rotation(integers, width)
    turned = integers.mapInArrow(
        _with_rotation(mean, axes, leading), "id long, vector array<long>, head array<double>, rest double"
    )
    turned = stored(turned, "rotated")
    total = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(width)]
    for _ in range(rounds):
        sums, _ = _assigned(mean, axes, leading, centroids)
        each = turned.mapInArrow(sums, "cluster int, rows long, total array<long>")
        moved = centroids.copy()
        for number, rows, *sums in each.groupBy("cluster").agg(F.sum("rows"), *total).collect():  # k rows
            if rows:
                moved[number] = [s // rows for s in sums]
        if (moved == centroids).all():
            break
        centroids = moved
    _, rows = _assigned(mean, axes, leading, centroids)
    final = stored(turned.mapInArrow(rows, "id long, cluster int, distance long"), "clusters")
    return Clusters(final, centroids.tolist())
