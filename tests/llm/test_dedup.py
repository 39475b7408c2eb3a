"""Exact and near duplicates, components."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from evlake.llm import common, near_dedup
from evlake.llm import components as components_module
from evlake.llm.components import components
from evlake.llm.exact_dedup import exact_duplicates
from evlake.llm.near_dedup import near_duplicates
from tests.llm.conftest import AWKWARD


def by_text(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[t or ""].append(i)
    return groups


def test_exact_against_brute_force(documents):
    rng = random.Random(3)
    base = ["".join(rng.choice("ab") for _ in range(n)) for n in (0, 1, 7, 8, 9, 15, 16, 17, 40)]
    texts = [(i, rng.choice(base)) for i in range(120)]
    got = {r.doc_id: r for r in exact_duplicates(documents(texts), block_bytes=8).collect()}
    for ids in by_text(texts).values():
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(ids), len(ids), i == max(ids))


def test_exact_awkward_rows(awkward, nothing):
    got = exact_duplicates(awkward).collect()
    assert len(got) == len(AWKWARD) and exact_duplicates(nothing).count() == 0
    assert Counter(r.group_size for r in got) == Counter(len(g) for g in by_text(AWKWARD).values() for _ in g)
    # One row of every distinct text stays, also of rows repeated in full.
    assert sum(r.kept for r in got) == len(by_text(AWKWARD))


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def shingles(text, k):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(texts, k, percent):
    sets = {i: shingles(t, k) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in ids}


def test_near_against_brute_force(documents):
    rng, texts = random.Random(5), []
    for _ in range(25):
        base = words(rng, 60)
        for _ in range(rng.randrange(1, 5)):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(999))
            texts.append(" ".join(copy))
    # A passage that all of them share makes large nodes.
    texts = [(i, "the same opening words of all these texts " * (i % 2) + t) for i, t in enumerate(texts)]
    got = near_duplicates(documents(texts), shingle_words=4).collect()
    want = brute_components(texts, 4, 80)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(shingles(t, 4)) for i, t in texts}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_awkward_rows(awkward, nothing):
    got = near_duplicates(awkward, shingle_words=4).collect()
    assert len(got) == len(AWKWARD)
    assert near_duplicates(nothing).count() == 0
    same = [r for r in got if r.n_shingles == 4]
    # Copies under ids 1 (twice), 7 and none are one group.
    assert len(same) == 4 and {r.component_id for r in same} == {1}
    assert all(r.component_id == r.doc_id for r in got if r.n_shingles == 0)


def test_components_by_either_way(spark, monkeypatch):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    links = spark.createDataFrame(edges, "a long, b long")
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    want = {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    assert {r.node: r.root for r in components(links).collect()} == want
    monkeypatch.setattr(components_module, "TASK_EDGES", 0)
    assert {r.node: r.root for r in components(links).collect()} == want
    assert components(links.where(F.lit(False))).count() == 0


def family(rng, base, edits):
    copy = list(base)
    for at in rng.sample(range(len(base)), edits):
        copy[at] = f"edit{rng.randrange(10**6)}"
    return " ".join(copy)


def test_deep_trees_against_brute_force(documents, monkeypatch):
    """With nodes of 10 sets at most compared at once, trees grow deeper; families around
    the threshold keep their nodes large."""
    monkeypatch.setattr(near_dedup, "SMALL_NODE", 10)
    levels, branch = [], near_dedup._branch
    monkeypatch.setattr(near_dedup, "_branch", lambda rows: levels.append(1) or branch(rows))
    rng, texts = random.Random(11), []
    # Single words changed in 120, so pairs of a family share about 0.68, 0.78 and 0.85.
    for edits in (6, 4, 3):
        base = words(rng, 120)
        texts += [family(rng, base, edits) for _ in range(14)]
    # Isolated pairs at 0.80 to 0.85.
    for _ in range(120):
        base = words(rng, 120)
        texts += [" ".join(base), family(rng, base, rng.choice([4, 5]))]
    texts = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(texts), shingle_words=4).collect()}
    want = brute_components(texts, 4, 80)
    linked = [i for i in want if want[i] != i]
    assert len(levels) > 2 and len(linked) > 80 and all(got[i] == got[got[i]] for i in got)
    # Nothing is linked that should not be, and hardly anything is missed.
    assert all(want[i] == want[got[i]] for i in got)
    assert sum(got[i] == want[i] for i in linked) >= 0.99 * len(linked)


def test_one_of_each_group(documents):
    """Also where ids are missing or repeat."""
    text = "one two three four five six seven eight nine ten"
    texts = [(None, text), (None, text + " "), (None, text + "  "), (7, "other words " + text[::-1]), (7, text[::-1] + " x")]
    texts += [(9, "a b c d e f g"), (None, "a b c d e f g "), (9, "a b c d e f g  "), (8, None), (None, "")]
    got = near_duplicates(documents(texts), shingle_words=4).collect()
    groups = Counter()
    for r in got:
        groups[r.n_shingles, r.component_id] += r.first
    shown = [r for r in got if r.n_shingles in (7, 4)]
    assert sum(r.first for r in shown if r.n_shingles == 7) == 1 and sum(r.first for r in shown if r.n_shingles == 4) == 1
    assert all(r.first for r in got if r.n_shingles == 0)


def test_texts_of_a_near_group_go_to_few_tiles(documents, monkeypatch):
    """A group just below the threshold, where every pair must be confirmed: its texts are
    not copied once per pair or per small tile, and the groups found are those of brute force."""
    copied, tiles_of = [], near_dedup._Join.compare_tiles

    def counted(self, candidates):
        tiles = near_dedup.stored(candidates, "seen")
        copied.append(tiles.agg(F.coalesce(F.sum(F.size("needed")), F.lit(0))).head()[0])
        tiles_of(self, tiles)

    monkeypatch.setattr(near_dedup._Join, "compare_tiles", counted)
    rng = random.Random(17)
    base = words(rng, 120)
    texts = list(enumerate([family(rng, base, 3) for _ in range(260)]))
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(texts), shingle_words=4).collect()}
    assert got == brute_components(texts, 4, 80)
    assert 0 < sum(copied) <= 6 * len(texts)


def test_pairs_of_earlier_nodes(monkeypatch):
    """Bits in common mean a smaller path in common; those without may have one."""
    rng, none = np.random.default_rng(5), near_dedup._NO_PATH
    places = rng.integers(-40, 40, (50, 6))
    places[rng.random(places.shape) < 0.3] = none
    for most in (2, 64):
        monkeypatch.setattr(near_dedup, "EARLIER", most)
        bits = near_dedup._earlier(10, places)
        for a in range(50):
            for b in range(50):
                shared = {p for p in places[a].tolist() if p < 10} & set(places[b].tolist())
                assert a == b or not bits[a] & bits[b] or shared
                assert a == b or most == 2 or bool(bits[a] & bits[b]) == bool(shared)


def test_small_nodes_store_few_tables(documents, monkeypatch):
    """Where every node is small, pairs are only looked at in tiles: nothing is compared
    with pivots first, and no table is stored for that, for texts or for sets' places."""
    names, folder = [], common.new_folder
    monkeypatch.setattr(common, "new_folder", lambda spark, name: names.append(name) or folder(spark, name))
    rng, texts = random.Random(23), []
    for edits in (1, 3):
        base = words(rng, 120)
        texts += [family(rng, base, edits) for _ in range(30)]
    texts = list(enumerate([*texts, *(" ".join(words(rng, 60)) for _ in range(40))]))
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(texts), shingle_words=4).collect()}
    assert got == brute_components(texts, 4, 80)
    assert len(set(got.values())) < len(texts) and len(names) <= 9


def test_tiles_hold_the_pairs_as_bits(monkeypatch):
    """The tiles of a node larger than a tile have all plausible pairs, each once."""
    monkeypatch.setattr(near_dedup, "TILE", 8)
    monkeypatch.setattr(near_dedup, "PAIRS", 50)
    rng, n, path = np.random.default_rng(3), 45, 100
    base = rng.integers(1, 256, 256)
    sketches = np.where(rng.random((n, 256)) < rng.random((n, 1)) / 3, rng.integers(0, 256, (n, 256)), base).astype(np.uint8)
    sizes, roots = rng.integers(90, 115, n), rng.integers(0, 20, n)
    fields = {"node": np.arange(n) + 1000, "root": roots, "n_shingles": sizes, "sketch": [s.tobytes() for s in sketches]}
    for most in (1, 64):
        monkeypatch.setattr(near_dedup, "EARLIER", most)
        places = [[path, *rng.choice([7, 8, 9, 120, 130], rng.integers(0, 3), replace=False).tolist()] for _ in range(n)]
        sets = pa.StructArray.from_arrays([pa.array(list(x)) for x in (*fields.values(), places)], [*fields, "paths"])
        batch = pa.RecordBatch.from_arrays([pa.array([path]), pa.ListArray.from_arrays([0, n], sets)], ["path", "sets"])
        got = []
        for tiles in near_dedup._exhaustive(80)(iter([batch])):
            for t in tiles.to_pylist():
                bits = np.unpackbits(np.frombuffer(t["pairs"], np.uint8), count=len(t["a"]) * len(t["b"]))
                here = [(a, b) for a in t["a"] for b in t["b"]]
                got += [pair for pair, bit in zip(here, bits.tolist(), strict=True) if bit]
                assert set(t["needed"]) == {*t["a"], *t["b"]} and max(len(t["a"]), len(t["b"])) <= 8
        want = []
        for i in range(n):
            for j in range(i + 1, n):
                first = min(set(places[i]) & set(places[j])) == path
                alike = all(
                    near_dedup._alike((sizes[[i]], sizes[[j]]), (sketches[[i], :k], sketches[[j], :k]), 80)[0] for k in (64, 256)
                )
                want += [(1000 + i, 1000 + j)] if first and alike and roots[i] != roots[j] else []
        assert sorted(got) == want and 100 < len(want) < n * (n - 1) // 2 - 100


def test_branching_takes_unlike_sets_apart(spark):
    """Small sets leave most bins of their sketches empty; that is nothing they share."""
    rng, n = np.random.default_rng(29), 400
    sketch = np.zeros((n, 256), np.uint8)
    for row in sketch:
        row[rng.choice(256, 15, replace=False)] = rng.integers(1, 256, 15)
    for odd in range(1, n, 2):  # every second set is the one before but for one of 15 bins
        sketch[odd] = sketch[odd - 1]
        sketch[odd, np.flatnonzero(sketch[odd])[0]] = 0
    rows = [(i, 77 + t, bytearray(s.tobytes())) for t in range(20) for i, s in enumerate(sketch)]
    rows = spark.createDataFrame(rows, "node long, path long, sketch binary").withColumn("turn", F.lit(0))
    children = defaultdict(set)
    for r in near_dedup._branch(rows).select("node", "path").collect():
        children[r.path].add(r.node)
    assert sum(len(x) for x in children.values()) == 20 * near_dedup.BRANCHES * n
    assert max(len(x) for x in children.values()) < n / 10
    together = sum(len(x & {i - 1 for i in x if i % 2}) for x in children.values()) / (20 * near_dedup.BRANCHES * n / 2)
    assert 0.8 < together < 1


def test_large_nodes_branch_or_go_by_blocks(documents, monkeypatch):
    """Texts that share only a line are taken apart by branching; a loose family is compared
    by blocks, and of a group known by its pivot only what is outside it. Each set is in few
    nodes, and the groups are those of brute force."""
    monkeypatch.setattr(near_dedup, "SMALL_NODE", 24)
    rows, split, blocks = [], [], []
    compare, of_blocks, of_split = near_dedup._Join.compare_nodes, near_dedup._Join.blocks, near_dedup._split

    def compared(self, given, percent):
        rows.append(given.count())
        compare(self, given, percent)

    def blocked(self, stuck, percent):
        found = of_blocks(self, stuck, percent)
        blocks.append(found.agg(F.max("chunks")).head()[0])
        return found

    def branched(large, classes):
        found = of_split(large, classes)
        split.append(found[0].count())
        return found

    monkeypatch.setattr(near_dedup._Join, "compare_nodes", compared)
    monkeypatch.setattr(near_dedup._Join, "blocks", blocked)
    monkeypatch.setattr(near_dedup, "_split", branched)
    rng = random.Random(31)
    line, base, tight = words(rng, 25), words(rng, 120), words(rng, 120)
    texts = [" ".join(line + words(rng, 40)) for _ in range(150)]
    for i in range(0, 60, 2):
        texts += [f"{texts[i]} {' '.join(words(rng, 3))}"]
    texts += [family(rng, base, 4) for _ in range(60)] + [family(rng, tight, 2) for _ in range(60)]
    texts = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(texts), shingle_words=4).collect()}
    want = brute_components(texts, 4, 80)
    assert got == want and 80 < sum(want[i] != i for i in want)
    assert sum(split) > 100 and blocks and blocks[0] > 1 and rows[0] < 3 * near_dedup.TOKENS * len(texts)


def test_a_text_goes_to_a_node_once():
    """Unless a node's texts are long; then its tiles have few."""
    rng, n = np.random.default_rng(37), 600
    base = rng.integers(1, 256, 256)
    sketches = np.where(rng.random((n, 256)) < 0.05, rng.integers(1, 256, (n, 256)), base).astype(np.uint8)
    for size, tiles in ((3000, 1), (40_000, 6)):
        sets = [
            {"node": i, "root": i, "n_shingles": 100, "row_bytes": size, "sketch": s.tobytes(), "paths": [5]}
            for i, s in enumerate(sketches)
        ]
        kinds = {"node": pa.int64(), "root": pa.int64(), "n_shingles": pa.int64(), "row_bytes": pa.int64()}
        kind = pa.list_(pa.struct(kinds | {"sketch": pa.binary(), "paths": pa.list_(pa.int64())}))
        batch = pa.RecordBatch.from_arrays([pa.array([5]), pa.array([sets], kind)], ["path", "sets"])
        got = [t for x in near_dedup._exhaustive(80)(iter([batch])) for t in x.to_pylist()]
        assert len(got) == tiles and sum(np.unpackbits(np.frombuffer(t["pairs"], np.uint8)).sum() for t in got) == n * (n - 1) // 2
        assert max(len(t["needed"]) for t in got) * size <= 2 * near_dedup.TILE_BYTES


def test_few_and_many_sets_are_looked_at_alike(monkeypatch):
    rng = np.random.default_rng(41)
    base = rng.integers(1, 256, 256)
    nodes = []
    for path in range(40):
        n = int(rng.integers(1, 9))
        sketches = np.where(rng.random((n, 256)) < rng.random((n, 1)) / 3, rng.integers(1, 256, (n, 256)), base).astype(np.uint8)
        nodes.append([
            {"node": 100 * path + i, "root": 100 * path + i // 2, "n_shingles": int(rng.integers(90, 115)), "sketch": s.tobytes(),
             "paths": [path, *rng.choice([-3, -2, 50], rng.integers(0, 3), replace=False).tolist()]}
            for i, s in enumerate(sketches)
        ])
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(nodes)], ["path", "sets"])
    found = []
    for few in (0, 16):
        monkeypatch.setattr(near_dedup, "FEW_SETS", few)
        tiles = [t for x in near_dedup._exhaustive(80)(iter([batch])) for t in x.to_pylist()]
        found.append(sorted((t["path"], t["a"], t["b"], t["pairs"]) for t in tiles))
    assert found[0] == found[1] and len(found[0]) > 10


def test_wanted_texts_by_bits(documents, monkeypatch):
    """Where too many texts are wanted to broadcast their keys, others hardly get shuffled
    and the groups are the same."""
    monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", 0)
    passed, maybe = [], near_dedup.with_maybe

    def counted(rows, *names):
        found = maybe(rows, *names)
        passed.append((found.count(), found.where("wanted").count()))
        return found

    monkeypatch.setattr(near_dedup, "with_maybe", counted)
    rng = random.Random(43)
    base = words(rng, 60)
    texts = list(enumerate([family(rng, base, 1) for _ in range(12)] + [" ".join(words(rng, 60)) for _ in range(200)]))
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(texts), shingle_words=4).collect()}
    assert got == brute_components(texts, 4, 80)
    assert passed == [(212, 12)]


def test_the_stage_joins_only_copies(spark, documents, awkward, tmp_path, monkeypatch):
    """The pipeline's second stage: whichever way, one row of each group, whole."""
    import corpus_pipeline

    monkeypatch.setattr(corpus_pipeline, "near_duplicates", lambda docs, **_: near_duplicates(docs, shingle_words=4))
    rng = random.Random(47)
    base = words(rng, 60)
    texts = [(100 + i, family(rng, base, 1)) for i in range(5)] + [(200 + i, " ".join(words(rng, 60))) for i in range(50)]
    docs = awkward.unionByName(documents(texts))
    joined, maybe, found = [], corpus_pipeline.with_maybe, []

    def counted(*given):
        rows = maybe(*given)
        joined.append(rows.where("__special").count())
        return rows

    monkeypatch.setattr(corpus_pipeline, "with_maybe", counted)
    for most in (corpus_pipeline.BROADCAST_ROWS, 0):
        monkeypatch.setattr(corpus_pipeline, "BROADCAST_ROWS", most)
        stage = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
        assert stage.columns == docs.columns
        found.append(Counter((r.doc_id, r.text, r.source) for r in stage.collect()))
    assert found[0] == found[1] and set(found[0].values()) == {1}
    # Of the family and the seven-word text one each; nulls, blanks and all others stay.
    assert sum(found[0].values()) == 9 + 1 + 50 and joined == [8]
