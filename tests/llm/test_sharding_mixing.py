"""Shards of equal bytes, sources in target weights."""

import random
import zlib
from collections import defaultdict

import pytest

from evlake.llm.mixing import mix, target_sizes
from evlake.llm.sharding import shards, write_shards
from tests.llm.conftest import AWKWARD


def brute_shards(texts, n):
    rows = sorted((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in texts)
    total, at, out, seen = sum(r[2] for r in rows), 0, {}, defaultdict(int)
    for i, crc, size in rows:
        shard = (at + (size - 1) // 2) * n // total
        out[i] = (size, crc, shard, seen[shard])
        seen[shard] += 1
        at += size
    return out


def test_shards_against_brute_force(documents):
    rng = random.Random(2)
    texts = [(i, "é" * rng.randrange(300)) for i in range(500)]
    got = shards(documents(texts), 16).collect()
    assert {r.doc_id: (r.size, r.text_crc32, r.shard, r.slot) for r in got} == brute_shards(texts, 16)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    assert sorted(shards(documents(texts[::-1]), 16).collect()) == sorted(got)


def test_shards_of_awkward_rows(awkward, nothing):
    got = shards(awkward, 4).collect()
    assert len(got) == len(AWKWARD) and shards(nothing).count() == 0
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_written_shards(spark, documents, tmp_path):
    docs = documents([(i, "x" * i) for i in range(60)])
    write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 60 and set(docs.columns) < set(back.columns)
    assert sorted((r.doc_id, r.shard_no) for r in back.collect()) == sorted(
        (r.doc_id, r.shard) for r in shards(docs, 4).collect()
    )


def test_targets():
    assert target_sizes([100, 100], [1, 1]) == [100, 100]
    # The small source is full at three times its size; the rest is shared again.
    assert target_sizes([10, 100, 100], [8, 1, 1]) == [30, 90, 90]
    assert target_sizes([0, 0], [5, 2]) == [0, 0] and target_sizes([], []) == []
    assert target_sizes([1, 1, 1000], [5, 2, 1]) == [3, 3, 996]


def mixed(docs):
    rows, taken = mix(docs)
    return sorted((r.doc_id or -1, r.row_hash, r.size, r.source_size, r.target, r.taken) for r in rows.collect()), taken


def test_mix_comes_near_its_targets(documents):
    rng = random.Random(4)
    texts = [(i, "w " * rng.randrange(1, 60)) for i in range(900)]
    docs = documents(texts)
    got, taken = mixed(docs)
    assert len(got) == 900 and mixed(docs.repartition(7))[0] == got
    by_source = defaultdict(lambda: [0, 0.0, 0])
    for i, _, size, whole, target, took in got:
        own = by_source["none" if i == 4 else i % 3]
        own[0], own[1], own[2] = whole, target, own[2] + took
        assert took <= 3 * size and took % max(size, 1) == 0
    assert sum(o[1] for o in by_source.values()) == pytest.approx(sum(r[2] for r in got))
    assert all(abs(o[2] - o[1]) <= 60 + 0.01 * o[1] for o in by_source.values())
    # Slots are taken once by a document and pass, and say what the mix holds.
    assert taken.selectExpr("sum(1) AS n").head().n == sum(r[5] // r[2] for r in got if r[2])


def test_mix_of_awkward_rows(awkward, nothing, documents):
    got, _ = mixed(awkward)
    assert len(got) == len(AWKWARD) and mixed(nothing)[0] == []
    assert [r[5] for r in mixed(documents([(1, None), (2, " ")]))[0]] == [0, 0]
