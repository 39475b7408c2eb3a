"""Clustering and near duplicates of vectors."""

import hashlib
import math
import random

import numpy as np
import pytest

from evlake.llm import clustering, embedding_dedup
from evlake.llm.clustering import cluster, nearest
from evlake.llm.embedding_dedup import hashes_of, near_vectors

#: Names that the operators use for columns of their own.
COLUMNS = "vec_id long, embedding array<float>, label int, row long, root long, id long, n long, vector string, size int"

NAN, INF = float("nan"), float("inf")


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 5, 6, 7, 8, "x", 9) for i, v in vectors], COLUMNS)


def around(rng, centre, noise, n):
    return (centre + noise * rng.normal(size=(n, len(centre)))).astype(np.float32).tolist()


def brute_clusters(vectors, k, rounds, seed=3):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: ((r[0] is None), hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def assign():
        out = []
        for i, v in kept:
            d, no = min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
            out.append((i, no, d))
        return out

    for _ in range(rounds):
        groups = {}
        for (_, v), (_, no, _) in zip(kept, assign()):
            groups.setdefault(no, []).append(v)
        for no, vs in groups.items():
            centroids[no] = [sum(x) // len(vs) for x in zip(*vs)]
    return assign(), centroids


def key(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def test_clusters_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 64))
    vectors = [(i, v) for i, v in enumerate(v for c in centres for v in around(rng, c, 0.4, 30))]
    vectors += [(900, vectors[0][1]), (0, vectors[0][1]), (None, vectors[3][1]), (901, [0.5] * 63), (902, None), (903, [])]
    vectors += [(904, [NAN] + [0.0] * 63), (905, [INF] + [0.0] * 63), (906, [None] + [0.0] * 63), (907, [0.0] * 64)]
    for rounds in (0, 1, 10):
        want, centroids = brute_clusters(vectors, 8, rounds)
        got = cluster(table(spark, vectors), rounds=rounds)
        assert key(tuple(r) for r in got.rows.collect()) == key(want)
        assert got.centroids == centroids
    rows = got.with_totals().collect()
    assert {r.inertia for r in rows} == {sum(d for _, _, d in want)}
    for r in rows:
        assert r.cluster_inertia == sum(d for _, no, d in want if no == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_few_and_no_vectors(spark):
    vectors = [(4, [1.0] * 64), (5, [1.0] * 64), (6, [-1.0] * 64)]
    want, _ = brute_clusters(vectors, 8, 10)
    assert key(tuple(r) for r in cluster(table(spark, vectors)).rows.collect()) == key(want)
    assert cluster(table(spark, [])).with_totals().count() == 0
    with pytest.raises(Exception, match="exceeds"):
        cluster(table(spark, [(1, [1e30] * 64)]))


def test_filter_measures_few(monkeypatch):
    """The bounds leave out most centroids and never the nearest."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-1000, 1000, (8, 64))
    x = centres[rng.integers(0, 8, 500)] + rng.integers(-200, 200, (500, 64))
    axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1]
    turned = [clustering._rotated(m, x.mean(0), axes, 16) for m in (x, centres)]
    best, distance = nearest(x, *turned[0], centres, *turned[1])
    every = ((x[:, None] - centres) ** 2).sum(-1)
    assert (best == every.argmin(1)).all() and (distance == every.min(1)).all()
    bound = ((turned[0][0][:, None] - turned[1][0]) ** 2).sum(-1) + (turned[0][1][:, None] - turned[1][1]) ** 2
    assert (bound <= every * (1 + 1e-9)).all() and (bound <= distance[:, None]).mean() < 0.2


def brute_links(vectors, least=0.95):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    linked = {n: set() for n in range(len(vectors))}
    good = [n for n, (_, v) in enumerate(vectors) if usable(v)]
    for width in {len(vectors[n][1]) for n in good}:
        same = [n for n in good if len(vectors[n][1]) == width]
        x = np.array([vectors[n][1] for n in same], np.float32).astype(float)
        x = x / np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(x @ x.T >= least)):
            if a != b:
                linked[same[a]].add(same[b])
    out, seen = [None] * len(vectors), set()
    for n in linked:
        if n not in seen:
            group, todo = {n}, [n]
            while todo:
                todo += linked[todo.pop()] - group
                group |= {x for m in group for x in linked[m]}
            while (more := {x for m in group for x in linked[m]} - group):
                group |= more
            ids = [vectors[m][0] for m in group if vectors[m][0] is not None]
            seen |= group
            for m in group:
                low = min(ids, default=None)
                out[m] = (vectors[m][0], len(linked[m]), low, vectors[m][0] == low)
    return out


def at_cosine(rng, v, cosine):
    other = rng.normal(size=len(v))
    other -= other @ v / (v @ v) * v
    return cosine * v / np.linalg.norm(v) + math.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


@pytest.mark.parametrize("sizes", [(256, 1024), (4, 16)])
def test_links_against_brute_force(spark, monkeypatch, sizes):
    """Also with components counted in tiles, and chains whose ends are not linked."""
    monkeypatch.setattr(embedding_dedup, "SMALL", sizes[0])
    monkeypatch.setattr(embedding_dedup, "TILE", sizes[1])
    rng = np.random.default_rng(4)
    vectors = list(enumerate(rng.normal(size=(300, 64)).tolist()))
    for n, cosine in enumerate([0.94, 0.949, 0.951, 0.96, 0.98, 0.999]):
        for m in range(10):
            vectors.append((1000 + 10 * n + m, at_cosine(rng, np.array(vectors[10 * n + m][1]), cosine).tolist()))
    centre = rng.normal(size=64)
    vectors += [(2000 + i, v) for i, v in enumerate(around(rng, centre, 0.05, 60))]
    vectors += [(2100 + i, v) for i, v in enumerate(around(rng, centre, 0.2, 60))]
    vectors += [(3000 + i, centre.tolist()) for i in range(40)]
    step = centre
    for i in range(30):
        step = at_cosine(rng, step, 0.97)
        vectors.append((4000 + i, step.tolist()))
    got = near_vectors(table(spark, vectors)).collect()
    assert key(tuple(r) for r in got) == key(brute_links(vectors))


def test_recall_and_a_group_larger_than_windows(spark, monkeypatch):
    """With small windows and blocks, so that few vectors stand for many."""
    monkeypatch.setattr(embedding_dedup, "WINDOW", 8)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 32)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(3000, 64))
    vectors = [(i, v.tolist()) for i, v in enumerate(base)]
    vectors += [(10_000 + i, at_cosine(rng, base[i], 0.952).tolist()) for i in range(500)]
    vectors += [(20_000 + i, v) for i, v in enumerate(around(rng, rng.normal(size=64), 0.02, 1500))]
    got = {r.vec_id: r for r in near_vectors(table(spark, vectors)).collect()}
    assert len(got) == len(vectors)
    found = sum(got[10_000 + i].component_id == i for i in range(500)) / 500
    assert found >= 0.9
    assert all(got[20_000 + i].n_links == 1499 and got[20_000 + i].component_id == 20_000 for i in range(1500))


def test_awkward_vectors(spark):
    one = np.random.default_rng(6).normal(size=64).tolist()
    vectors = [(1, one), (1, one), (2, one), (None, one), (3, None), (4, []), (5, [0.0] * 64), (6, [NAN] + one[1:])]
    vectors += [(7, [INF] + one[1:]), (8, [None] + one[1:]), (9, [x * 1e-30 for x in one]), (10, [x * 1e30 for x in one])]
    vectors += [(11, one[:2]), (12, one[:2]), (None, [1.0]), (None, [2.0]), (13, [-3.0]), (14, [1.0] * 5000), (15, [1.0] * 5000)]
    got = near_vectors(table(spark, vectors)).collect()
    want = [(i, n, c, k if c is not None else True) for i, n, c, k in brute_links(vectors)]
    assert key(tuple(r) for r in got) == key(want)
    assert near_vectors(table(spark, [])).count() == 0


def test_close_vectors_share_hashes():
    """The figure the docstring gives for a pair at 0.95."""
    rng = np.random.default_rng(7)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = np.array([at_cosine(rng, v, 0.95) for v in a])
    turns = np.linalg.qr(rng.normal(size=(64, 64)))[0][None]
    assert 0.5 < (hashes_of(a, turns) == hashes_of(b, turns)).mean() < 0.7
