"""Near duplicates by a chosen-path set similarity join.

Every text is a set of word shingles with minwise tokens. A tree starts with all sets at
its root; each set branches to the child of the token it has in a place that the node
picks, once per place picked. Similar sets share most tokens and so meet in many
children. Nodes of few sets are compared exhaustively by sketches and confirmed. A larger
node branches on if that leaves less to compare, as where unlike texts share a line. If
not, its sets are much alike: all are compared with one pivot, and unless the node proves
to be of one group, what is outside its largest group is compared with all, by blocks.

Trees are independent: at the root every tree has ``BRANCHES`` tokens of its own, and a
deeper node picks, by a hash of its path, among the ``BINS`` bins of the sketch, whose
least hashes are minwise tokens too; for an empty bin the next one stands. A pair at the
threshold of 0.8 is missed by one tree with probability 0.04 at the first level and
0.0625 however deep the tree, so by all ``TREES`` with 4e-9 and 6e-8.

Sets that are equal are one class from the start. Pairs are confirmed on the full
shingle sets (64-bit hashes) before they count as links; pairs inside a group that is
already connected need no comparison, which is why no group of copies is ever
expanded into its pairs.

Defined results: a null or blank text has no shingles and is linked with nothing; a
null id is no group's smallest unless all its ids are null; rows repeating an id with
another text are documents of their own. An empty table gives an empty result.
"""

from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evlake.llm.arrays import mix, sets_of, shingles_of, slices, texts_of, words_of
from evlake.llm.common import KEY, NO_ID, drop_stored, row_key, stored, whole, with_lookup, with_maybe
from evlake.llm.components import components

TREES = 6
BRANCHES = 2
#: Minwise tokens of a set, for the first level.
TOKENS = TREES * BRANCHES
#: Nodes of up to so many sets are compared exhaustively: some 1 MB of sketches and, at
#: the most, a few seconds. Larger ones are, if they must be, by blocks of so many sets.
SMALL_NODE = 4096
#: Nodes of up to so many sets are looked at together.
FEW_SETS = 16
#: Places that a larger node may try in turn, and the share of its pairs that its children
#: may have at the most.
TURNS = 3
PAIRS_LEFT = 0.5
#: Sets on either side of a tile, the part of a node's pairs that is confirmed at once,
#: and bytes of their texts. A tile is a whole node unless its texts are long, so a text
#: mostly goes to a node once. And the pairs of sketches that are looked at together, and
#: the nodes and tiles that a task holds at a time.
TILE = 4096
TILE_BYTES = 8 << 20
PAIRS = 16384
BATCH_NODES = 16
BATCH_TILES = 4
#: Paths by which a node's sets are known to meet in an earlier node, bits of a number.
EARLIER = 64
#: A list of wanted texts, and of linked sets, of up to so many rows (some 10 MB) is
#: broadcast to the scan; beyond that the rows are shuffled, of the texts only those that
#: a table of bits lets pass.
BROADCAST_ROWS = 200_000
#: Bins of a sketch: each holds a byte of the least hash that falls into it.
BINS = 256
#: Pairs are dropped unconfirmed only if their sketches agree in so many standard
#: deviations fewer bins than a pair at the threshold (probability 2e-8).
DEVIATIONS = 5.5
#: Bins that are looked at first.
FIRST_BINS = 64

_random = np.random.default_rng(20240607)
_XOR = _random.integers(0, 2**64, TOKENS, np.uint64)
_TIMES = _random.integers(0, 2**63, TOKENS, np.uint64) * np.uint64(2) + np.uint64(1)


def _sketches(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in slices(whole_batch, "text"):
                hashes, offsets = shingles_of(words_of(*texts_of(batch.column("text"))), shingle_words)
                some = np.flatnonzero(offsets[:-1] < offsets[1:])
                tokens = np.zeros((batch.num_rows, TOKENS), np.int32)
                fp = np.zeros((2, batch.num_rows), np.uint64)
                if len(some):
                    for i in range(TOKENS):
                        least = np.minimum.reduceat((hashes ^ _XOR[i]) * _TIMES[i], offsets[some])
                        tokens[some, i] = (least >> np.uint64(17)).astype(np.uint32).view(np.int32)
                own, offsets = sets_of(hashes, offsets)
                sketch = np.zeros((batch.num_rows, BINS), np.uint8)
                row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
                # Sorted by hash, so written backwards the least of a bin stays.
                sketch[row[::-1], own[::-1] % BINS] = mix(own[::-1]) % 255 + 1
                if len(some):
                    fp[0, some] = np.add.reduceat(own * (own >> np.uint64(32) | np.uint64(1)), offsets[some])
                    fp[1, some] = np.bitwise_xor.reduceat(own, offsets[some])
                columns = [batch.column(k) for k in KEY] + [
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array(fp[0].view(np.int64)),
                    pa.array(fp[1].view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, TOKENS * batch.num_rows + 1, TOKENS, dtype=np.int32)),
                        pa.array(tokens.reshape(-1)),
                    ),
                    pa.array([s.tobytes() for s in sketch], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*KEY, "n_shingles", "fp1", "fp2", "tokens", "sketch"])

    return run


SKETCH = "row_id long, row_hash long, row_bytes long, n_shingles long, fp1 long, fp2 long, tokens array<int>, sketch binary"
CLASS = ["fp1", "fp2", "n_shingles"]


def _confirm(shingle_words: int, percent: int):
    """Keeps the pairs of texts whose full shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in slices(whole_batch, "text_a"):
                sides = []
                for column in ("text_a", "text_b"):
                    words = words_of(*texts_of(batch.column(column)))
                    sides.append(sets_of(*shingles_of(words, shingle_words)))
                (a, at_a), (b, at_b) = sides
                similar = []
                for i in range(batch.num_rows):
                    one, two = a[at_a[i] : at_a[i + 1]], b[at_b[i] : at_b[i + 1]]
                    shared = len(np.intersect1d(one, two, assume_unique=True))
                    similar.append(100 * shared >= percent * (len(one) + len(two) - shared) > 0)
                yield batch.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

    return run


def _counts(marks: np.ndarray) -> np.ndarray:
    """Marks per row, of which there are a multiple of eight: eight bytes at a time."""
    return np.bitwise_count(marks.view(np.uint64)).sum(-1, dtype=np.int64)


def _alike(sizes: tuple, sketches: tuple, percent: int) -> np.ndarray:
    """Whether sets' sizes and sketches allow the similarity asked for."""
    one, two = sketches
    share = percent / 100
    bins = _counts((one | two) > 0)
    same = _counts((one == two) & (one > 0))
    least = share * bins - DEVIATIONS * np.sqrt(share * (1 - share) * bins)
    return (np.minimum(*sizes) * 100 >= np.maximum(*sizes) * percent) & (same >= least)


def _candidates(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs (one, two) of sets may be similar: by their sizes, a part of the
    bins, and then all of them."""
    found = np.flatnonzero(np.minimum(sizes[one], sizes[two]) * 100 >= np.maximum(sizes[one], sizes[two]) * percent)
    for bins in (FIRST_BINS, BINS):
        a, b = one[found], two[found]
        found = found[_alike((sizes[a], sizes[b]), (sketches[a, :bins], sketches[b, :bins]), percent)]
    return found


def _sketch_rows(column: pa.Array) -> np.ndarray:
    data, offsets = texts_of(column)
    return data.reshape(len(offsets) - 1, BINS)


def _plausible(percent: int):
    """Keeps the pairs (a, b) that their sizes and sketches leave possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            sketches = [_sketch_rows(batch.column(c)) for c in ("sketch_a", "sketch_b")]
            yield batch.select(["a", "b"]).filter(pa.array(_alike(sizes, sketches, percent)))

    return run


def _joined(batch: pa.RecordBatch, columns: list[str]) -> tuple[dict, list[np.ndarray]]:
    """Fields of the sets in lists, those of all columns one after the other, and where
    each row's lists begin."""
    parts, first, before = [], [], 0
    for column in columns:
        lists = batch.column(column)
        parts.append(lists.values)
        first.append(lists.offsets.to_numpy() + before)
        before += len(lists.values)
    sets = pa.concat_arrays(parts)
    found = {c: sets.field(c).to_numpy() for c in ("node", "root", "n_shingles")}
    found |= {"sketch": _sketch_rows(sets.field("sketch")), "places": _padded(sets.field("paths"))}
    known = sets.type.get_field_index("row_bytes") >= 0
    return found | {"bytes": sets.field("row_bytes").to_numpy() if known else np.zeros(len(sets), np.int64)}, first


def _exhaustive(percent: int):
    """Plausible pairs, between groups not yet linked, of every node's ``sets`` or, if there
    are such, between them and the ``others``, packed by tiles of the node's square of
    pairs: a row per tile with the sets it needs. A pair that meets in several nodes belongs
    to the one with the smallest path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            fields, first = _joined(batch, [c for c in ("sets", "others") if c in names])
            paths, blocks = (batch.column(c).to_pylist() for c in ("path", "block" if "block" in names else "path"))
            counts = [np.diff(x) for x in first]
            few = (sum(counts) <= FEW_SETS) & (sum(counts) == counts[0])
            found = _pairs_of_few(batch.column("path").to_numpy(), fields, first[0], few, percent)
            for r in np.flatnonzero(~few).tolist():
                spans = [np.arange(x[r], x[r + 1]) for x in first]
                here = {k: v[np.concatenate(spans)] for k, v in fields.items()}
                side = np.repeat(np.arange(len(spans)), [len(x) for x in spans]) if len(spans[-1]) and len(spans) > 1 else None
                found[r] = _node_pairs(paths[r], here, side, percent)
            for r, pairs in found.items():
                if pairs is not None:
                    own = np.concatenate([np.arange(x[r], x[r + 1]) for x in first])
                    yield from _tiles(blocks[r], fields["node"][own], fields["bytes"][own], pairs)

    return run


@cache
def _pairs_among(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def _pairs_of_few(path: np.ndarray, fields: dict, first: np.ndarray, few: np.ndarray, percent: int) -> dict:
    """:func:`_node_pairs` of the rows with few sets, by row, all at once."""
    rows = np.flatnonzero(few & (np.diff(first) > 1))
    if not len(rows):
        return {}
    each = [_pairs_among(n) for n in (first[rows + 1] - first[rows]).tolist()]
    row = np.repeat(rows, [len(a) for a, _ in each])
    one, two = (np.concatenate([x[i] for x in each]) + first[row] for i in (0, 1))
    other = np.flatnonzero(fields["root"][one] != fields["root"][two])
    found = other[_candidates(one[other], two[other], fields["n_shingles"], fields["sketch"], percent)]
    row, one, two, places = row[found], one[found], two[found], fields["places"]
    own = np.flatnonzero(_belongs(path[row], places[one], places[two]))
    tables = {}
    for r, a, b in zip(row[own].tolist(), one[own].tolist(), two[own].tolist(), strict=True):
        if r not in tables:
            tables[r] = np.zeros((first[r + 1] - first[r],) * 2, bool)
        tables[r][a - first[r], b - first[r]] = True
    return tables


def _node_pairs(path: int, sets: dict, side: np.ndarray | None, percent: int) -> np.ndarray | None:
    """A table of bits for the pairs (earlier, later set) that may be similar and belong to
    this node, or None. With ``side`` the sets of a pair are of different sides."""
    order = np.argsort(sets["n_shingles"], kind="stable")
    root, size, sketch, places = (sets[k][order] for k in ("root", "n_shingles", "sketch", "places"))
    side = None if side is None else side[order]
    earlier, pairs, n = _earlier(path, places), None, len(order)
    # With a bit left over, every path that is shared has one.
    exact = int(np.bitwise_or.reduce(earlier)) < 1 << EARLIER - 1
    # By size, the sets that one may be similar to lie behind it up to an end.
    ends, start = np.searchsorted(size, size * 100 // percent, side="right").tolist(), 0
    while start < n - 1:
        stop = min(start + TILE, n - 1)
        while stop - start > 1 and (stop - start) * (ends[stop - 1] - start) > PAIRS:
            stop = (start + stop) // 2
        if (end := ends[stop - 1]) > start + 1:
            rows, behind = slice(start, stop), slice(start + 1, end)
            here = root[rows, None] != root[behind]
            here &= earlier[rows, None] & earlier[behind] == 0
            if side is not None:
                here &= side[rows, None] != side[behind]
            one, two = np.nonzero(np.triu(here))
            one, two = one + start, two + start + 1
            found = _candidates(one, two, size, sketch, percent)
            if not exact:
                found = found[_belongs(path, places[one[found]], places[two[found]])]
            if len(found):
                pairs = np.zeros((n, n), bool) if pairs is None else pairs
                a, b = order[one[found]], order[two[found]]
                pairs[np.minimum(a, b), np.maximum(a, b)] = True
        start = stop
    return pairs


#: Fills the rows of a table of paths; no path is so.
_NO_PATH = np.iinfo(np.int64).max


def _padded(paths: pa.ListArray) -> np.ndarray:
    """Lists of paths as a table."""
    ends, values = paths.offsets.to_numpy(), paths.values.to_numpy()
    counts = np.diff(ends)
    table = np.full((len(counts), max(int(counts.max(initial=0)), 1)), _NO_PATH)
    table[np.arange(table.shape[1]) < counts[:, None]] = values[ends[0] : ends[-1]]
    return table


def _earlier(path: int, places: np.ndarray) -> np.ndarray:
    """Bits for the most shared of the paths smaller than ``path``: sets with a bit in
    common meet there, so their pair need not be looked at here. Only a part of the
    paths has bits; :func:`_belongs` decides."""
    found, at, counts = np.unique(places, return_inverse=True, return_counts=True)
    shared = np.flatnonzero((found < path) & (counts > 1))
    shared = shared[np.argsort(-counts[shared], kind="stable")[:EARLIER]]
    bits = np.zeros(len(found), np.uint64)
    bits[shared] = np.uint64(1) << np.arange(len(shared), dtype=np.uint64)
    return np.bitwise_or.reduce(bits[at.reshape(places.shape)], axis=1)


def _belongs(path: int | np.ndarray, ones: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether ``path`` is the smallest that the sets of each pair share."""
    shared = (others[:, :, None] == ones[:, None, :]).any(2)
    return np.where(shared, others, _NO_PATH).min(1, initial=_NO_PATH) == path


def _segments(sizes: np.ndarray) -> list[slice]:
    """Parts of up to TILE places with about TILE_BYTES."""
    cuts, total = [0], 0
    for i, size in enumerate(sizes.tolist()):
        if i - cuts[-1] == TILE or total and total + size > TILE_BYTES:
            cuts.append(i)
            total = 0
        total += size
    return [slice(a, b) for a, b in zip(cuts, [*cuts[1:], len(sizes)], strict=True)]


def _tiles(block: int, node: np.ndarray, sizes: np.ndarray, pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The table of pairs packed by tile, each as the bits of a table of the sets on either side."""
    used = np.flatnonzero(pairs.any(0) | pairs.any(1))
    segments, kinds = _segments(sizes[used]), [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary()]
    for s, one in enumerate(segments):
        for t, two in enumerate(segments[s:], s):
            bits = pairs[used[one]][:, used[two]]
            a, b = np.flatnonzero(bits.any(1)), np.flatnonzero(bits.any(0))
            if len(a):
                bits, a, b = bits[a][:, b], used[one][a], used[two][b]
                row = (block, s << 32 | t, node[np.union1d(a, b)], node[a], node[b], np.packbits(bits).tobytes())
                columns = [pa.array([c], k) for c, k in zip(row, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["path", "tile", "needed", "a", "b", "pairs"])


TILES = "path long, tile long, needed array<long>, a array<long>, b array<long>, pairs binary"


def _confirm_tile(shingle_words: int, percent: int):
    """Links among a tile's texts, each taken apart once; of links that close a circle
    within the tile none is needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("members")
            first = members.offsets.to_numpy()
            names = members.values.field("node").to_numpy()
            # Texts of several tiles are taken apart together unless they are many.
            step = batch.num_rows if members.values.field("text").nbytes <= TILE_BYTES else 1
            for t in range(batch.num_rows):
                if t % step == 0:
                    before, after = first[t], first[min(t + step, batch.num_rows)]
                    found, counts = _texts_sets(members.values.slice(before, after - before).field("text"), shingle_words)
                    ends = np.concatenate(([0], np.cumsum(counts)))
                own = slice(first[t] - before, first[t + 1] - before)
                node, sizes = names[first[t] : first[t + 1]], counts[own]
                place = {x: i for i, x in enumerate(node.tolist())}
                one, two = (np.array([place[x] for x in batch.column(c)[t].as_py()], np.int64) for c in ("a", "b"))
                bits = np.unpackbits(np.frombuffer(batch.column("pairs")[t].as_py(), np.uint8), count=len(one) * len(two))
                bits = bits.reshape(len(one), len(two)).view(bool)
                links = _links(found[ends[own.start] : ends[own.stop]], sizes, one, two, bits, percent)
                if links:
                    a, b = np.array(links).T
                    yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["a", "b"])

    return run


def _texts_sets(texts: pa.Array, shingle_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' sets of shingles one after the other, and their sizes."""
    found, counts = [], []
    for piece in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
        hashes, at = sets_of(*shingles_of(words_of(*texts_of(piece.column("text"))), shingle_words))
        found.append(hashes)
        counts.append(np.diff(at))
    return np.concatenate(found), np.concatenate(counts)


def _links(
    hashes: np.ndarray, counts: np.ndarray, one: np.ndarray, two: np.ndarray, bits: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Pairs of similar sets among those that ``bits`` marks, enough to tell the groups.
    Sets are compared by marks over numbered shingles, several with one at once."""
    known, numbers = np.unique(hashes, return_inverse=True)
    ends = np.cumsum(counts)
    starts, group, links = ends - counts, np.arange(len(counts)), []
    marks = np.zeros(len(known), bool)
    for i, a in enumerate(one.tolist()):
        rest = two[bits[i]]
        rest = rest[group[rest] != group[a]]
        if not len(rest):
            continue
        own, many = numbers[starts[a] : ends[a]], 2
        marks[own] = True
        while len(rest):
            some, rest, many = rest[:many], rest[many:], min(2 * many, 64)
            sets = [numbers[s:e] for s, e in zip(starts[some].tolist(), ends[some].tolist(), strict=True)]
            sizes = counts[some]
            shared = np.add.reduceat(marks[np.concatenate(sets)], np.cumsum(sizes) - sizes, dtype=np.int64)
            for b in some[100 * shared >= percent * (counts[a] + sizes - shared)].tolist():
                if group[a] != group[b]:
                    group[group == group[b]] = group[a]
                    links.append((a, b))
            rest = rest[group[rest] != group[a]]
        marks[own] = False
    return links


@contextmanager
def _few_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows, for rows that are long lists."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class _Join:
    """State of one run: the classes, the texts fetched so far and the links found."""

    def __init__(self, texts: DataFrame, classes: DataFrame, shingle_words: int, percent: int):
        self.texts, self.classes = texts, classes
        self.confirm = _confirm(shingle_words, percent)
        self.confirm_tile = _confirm_tile(shingle_words, percent)
        self.fetched: list[DataFrame] = []
        self.links: list[DataFrame] = []
        self.roots: DataFrame | None = None

    def _fetch(self, need: DataFrame, most: int, again: bool = True) -> DataFrame:
        """Texts of the classes ``need`` (node, ``most`` rows). Each is fetched once in a
        run, and kept if any is to be read ``again``."""
        for have in self.fetched:
            need = need.join(have.select("node"), "node", "left_anti")
        own, texts = self.classes.select("node", *KEY), self.texts
        if most <= BROADCAST_ROWS:
            keyed = F.broadcast(own.join(F.broadcast(need), "node", "left_semi"))
        else:
            # Stored, so that its size is known when the join is planned.
            keyed = stored(own.join(need.distinct(), "node", "left_semi"), "wanted")
            if keyed.count() <= BROADCAST_ROWS:
                keyed = F.broadcast(keyed)
            else:
                texts = with_maybe(texts, "row_hash", keyed, "row_hash", "wanted").where("wanted").drop("wanted")
        # Rows repeated in full have one key, and any of them will do.
        own = texts.join(keyed, KEY).select("node", "text").dropDuplicates(["node"])
        if not again:
            return reduce(DataFrame.unionByName, [*self.fetched, own])
        self.fetched.append(stored(own, "pair-texts"))
        return reduce(DataFrame.unionByName, self.fetched)

    def plausible(self, pairs: DataFrame, percent: int) -> DataFrame:
        """Those of the pairs (pivot a, b) that sizes and sketches leave possible."""
        pairs = stored(pairs, "stars")
        own = self.classes.select("node", "n_shingles", "sketch")
        of_a = own.withColumnsRenamed({"node": "a", "n_shingles": "n_a", "sketch": "sketch_a"})
        pivots = pairs.groupBy("a").agg(F.count("*").alias("n")).join(of_a, "a")
        known = with_lookup(pairs, pivots, ["a"], "n", pairs.count())
        both = known.join(own.withColumnsRenamed({"node": "b", "n_shingles": "n_b", "sketch": "sketch_b"}), "b")
        return both.mapInArrow(_plausible(percent), "a long, b long")

    def compare(self, candidates: DataFrame) -> None:
        """Confirm candidate pairs (a, b); the similar ones join their groups."""
        pairs = stored(candidates, "pairs")
        count = pairs.count()
        if not count:
            return
        texts = self._fetch(pairs.select(F.explode(F.array("a", "b")).alias("node")), 2 * count)
        # Plain joins of stored tables, so that adaptive execution can split the
        # partition of a pivot with very many partners.
        with_b = pairs.join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
        both = with_b.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
        self._found(stored(both.mapInArrow(self.confirm, "a long, b long"), "links"))

    def compare_tiles(self, candidates: DataFrame) -> None:
        """The same for the tiles of nodes. A text goes to each of its tiles once, not once
        per pair; it is not kept."""
        with _few_rows(candidates.sparkSession, BATCH_NODES):
            tiles = stored(candidates, "tiles")
            count = tiles.agg(F.coalesce(F.sum(F.size("needed")), F.lit(0))).head()[0]
            if not count:
                return
            each = tiles.select("path", "tile", F.explode("needed").alias("node"))
            texts = self._fetch(each.select("node"), count, again=False)
            members = each.join(texts, "node").groupBy("path", "tile")
            whole_tiles = members.agg(F.collect_list(F.struct("node", "text")).alias("members")).join(
                tiles.drop("needed"), ["path", "tile"]
            )
        with _few_rows(candidates.sparkSession, BATCH_TILES):
            whole_tiles = whole_tiles.select("members", "a", "b", "pairs")
            found = stored(whole_tiles.mapInArrow(self.confirm_tile, "a long, b long"), "links")
        self._found(found)

    def _found(self, found: DataFrame) -> None:
        if found.isEmpty():
            return
        # The links before are known by their roots.
        self.links = [*self.links[-1:], found]
        self.roots = stored(components(reduce(DataFrame.unionByName, self.links)), "roots")
        self.links.append(self.roots.select(F.col("node").alias("a"), F.col("root").alias("b")))

    def grouped(self, rows: DataFrame) -> DataFrame:
        """The rows (by node) with the roots of their groups."""
        if self.roots is None:
            # Nothing is linked, so every set is a group.
            return rows.withColumn("root", F.col("node"))
        roots = F.broadcast(self.roots) if self.roots.count() <= BROADCAST_ROWS else self.roots
        return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def blocks(self, stuck: DataFrame, percent: int) -> DataFrame:
        """The sets (path, size, node) of large nodes that branching doesn't split, by
        chunks: all are compared with a pivot, and of nodes that then are of several groups
        the largest one comes last. Its chunks from ``few`` on need no comparison."""
        pivots = stuck.groupBy("path").agg(F.min("node").alias("a"), F.count("*").alias("n"))
        total = stuck.count()
        stars = with_lookup(stuck, pivots, ["path"], "n", total, BROADCAST_ROWS).where("node <> a")
        self.compare(self.plausible(stars.select("a", F.col("node").alias("b")).distinct(), percent))
        placed = stored(self.grouped(stuck.select("path", "node")), "placed")
        largest = placed.groupBy("path", "root").agg(F.count("*").alias("own")).groupBy("path")
        largest = largest.agg(F.max_by("root", F.struct("own", "root")).alias("main"), F.max("own").alias("own"), F.sum("own").alias("n"))
        chunks = F.ceil(F.col("own") / SMALL_NODE).cast("int"), F.ceil((F.col("n") - F.col("own")) / SMALL_NODE).cast("int")
        several = largest.where("own < n").select("path", "main", "n", chunks[0].alias("last"), chunks[1].alias("few"))
        found = with_lookup(placed, several, ["path"], "n", total, BROADCAST_ROWS)
        at, many = F.xxhash64("node", F.lit(7)), F.col("few") + F.col("last")
        chunk = F.when(F.col("root") == F.col("main"), F.col("few") + F.pmod(at, F.col("last"))).otherwise(F.pmod(at, F.col("few")))
        return stored(found.select("path", "node", chunk.cast("int").alias("chunk"), "few", many.alias("chunks")), "blocks")

    def compare_nodes(self, rows: DataFrame, percent: int) -> None:
        """Compare the sets (path, node) of small nodes and blocks, chunk by chunk."""
        # Every set with all the nodes it is in, to tell where a pair belongs.
        own = rows.groupBy("node").agg(F.collect_list(F.struct("path", "chunk", "few", "chunks")).alias("places"))
        own = self.grouped(own).join(self.classes.select("node", "n_shingles", "row_bytes", "sketch"), "node")
        own = own.select("node", "root", "n_shingles", "row_bytes", "sketch", F.col("places.path").alias("paths"), "places")
        with_chunks = F.expr("sequence(0, if(place.chunk < place.few, place.chunks, place.few) - 1)")
        each = own.select("*", F.explode("places").alias("place")).select("*", F.explode(with_chunks).alias("other"))
        low, high = F.least("place.chunk", "other"), F.greatest("place.chunk", "other")
        block = F.when(high == 0, F.col("place.path")).otherwise(F.xxhash64("place.path", low, high))
        entry = F.struct("node", "root", "n_shingles", "row_bytes", "sketch", "paths")
        second = F.col("place.chunk") > F.col("other")
        nodes = each.groupBy(F.col("place.path").alias("path"), block.alias("block")).agg(
            F.collect_list(F.when(~second, entry)).alias("sets"), F.collect_list(F.when(second, entry)).alias("others")
        )
        self.compare_tiles(nodes.mapInArrow(_exhaustive(percent), TILES))


def _roots(classes: DataFrame) -> DataFrame:
    """The first level: each set's children in all trees, by tokens of the tree's own."""
    children = [
        F.xxhash64(F.lit(t), F.lit(i), F.element_at("tokens", t * BRANCHES + i + 1))
        for t in range(TREES)
        for i in range(BRANCHES)
    ]
    return classes.select("node", F.explode(F.array(*children)).alias("path"))


def _branch(rows: DataFrame) -> DataFrame:
    """Children of each set's node: ``node``, ``path``, ``turn`` (which of the places the
    node may pick) and ``sketch`` in, the child's path and its ``parent`` out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parent, turn = (batch.column(c).to_numpy() for c in ("path", "turn"))
            sketch = _sketch_rows(batch.column("sketch"))
            for i in range(BRANCHES):
                path = _child(parent.view(np.uint64), turn.astype(np.uint64) * np.uint64(BRANCHES) + np.uint64(i), sketch)
                columns = [batch.column(c) for c in ("node", "turn", "path")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(path.view(np.int64))], ["node", "turn", "parent", "path"])

    return rows.select("node", "path", "turn", "sketch").mapInArrow(run, "node long, turn int, parent long, path long")


def _child(parent: np.ndarray, place: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Paths of the children by one of the parents' places: the first bin from there on,
    round the sketch, that isn't empty, with what it holds."""
    picked = mix(parent + (place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    bins = ((picked % np.uint64(BINS)).astype(np.int64)[:, None] + np.arange(BINS)) % BINS
    rows = np.arange(len(sketch))
    bins = bins[rows, (sketch[rows[:, None], bins] > 0).argmax(1)]
    token = bins * BINS + sketch[rows, bins]
    return mix(picked + (token.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def _split(large: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Children (node, path) of the large nodes that branching helps, by the first turn
    that leaves few enough pairs, and the rows of the others."""
    rows = large.join(classes.select("node", "sketch"), "node")
    turns = [_branch(rows.withColumn("turn", F.lit(t))) for t in range(TURNS)]
    children = stored(reduce(DataFrame.unionByName, turns), "children")
    pairs = children.groupBy("parent", "turn", "path").agg(F.count("*").alias("n")).groupBy("parent", "turn")
    pairs = pairs.agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1)).alias("left"))
    size = F.col("n") / BRANCHES
    helped = pairs.where(F.col("left") <= PAIRS_LEFT * size * (size - 1)).groupBy("parent")
    # At most a row per SMALL_NODE rows of large nodes.
    helped = stored(helped.agg(F.min("turn").alias("turn")), "turns")
    if helped.count() <= BROADCAST_ROWS:
        helped = F.broadcast(helped)
    rows = stored(children.join(helped, ["parent", "turn"]).select("node", "path"), "rows")
    stuck = stored(large.join(helped.withColumnRenamed("parent", "path"), "path", "left_anti"), "stuck")
    drop_stored(children)
    return rows, stuck


def _classes(sketches: DataFrame) -> DataFrame:
    """One row per distinct set with a node number of its own, the key of one of its
    rows, the smallest id, its size and its signature."""
    grouped = (
        sketches.where("n_shingles > 0")
        .groupBy(*CLASS)
        .agg(
            F.min(F.struct(F.col("row_id") == NO_ID, *KEY)).alias("least"),
            F.count("*").alias("members"),
            F.first("tokens").alias("tokens"),
            F.first("sketch").alias("sketch"),
        )
        .select(*CLASS, *[f"least.{k}" for k in KEY], "members", "tokens", "sketch")
    )
    # An id that one set has is its node; where ids are null or repeat it is a hash.
    hashed = -F.shiftrightunsigned(F.xxhash64("fp1", "fp2", "n_shingles"), 1) - 1
    given = F.col("row_id") != NO_ID
    sets = F.count("*").over(Window.partitionBy(F.when(given, F.col("row_id")).otherwise(hashed)))
    own = given & (F.col("sets") == 1)
    return grouped.withColumn("sets", sets).withColumn("node", F.when(own, F.col("row_id")).otherwise(hashed))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Groups of documents linked by shingle sets with ``percent`` in common.

    Returns a row per row of ``docs``: its ``KEY``, doc_id, n_shingles, component_id
    (the group's smallest id), kept (whether it has that id) and first (whether its key
    is the group's smallest, ids before null: one key of each group, whatever its ids).
    """
    text = whole(text_column)
    texts = docs.select(*row_key(id_column, text), text.alias("text"))
    sketches = stored(texts.mapInArrow(_sketches(shingle_words), SKETCH), "sketches")
    classes = stored(_classes(sketches), "classes")
    join = _Join(texts, classes, shingle_words, percent)

    rows, total = _roots(classes), classes.count() * TREES * BRANCHES
    small, stuck = [], []
    while total:
        sizes = rows.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        live = with_lookup(rows, sizes.withColumn("n", F.col("size")), ["path"], "n", total, BROADCAST_ROWS)
        live = stored(live, "live")
        is_large, total = F.col("size") > SMALL_NODE, 0
        small.append(live.where(~is_large).select("path", "node"))
        large = live.where(is_large).select("path", "node")
        if not large.isEmpty():
            rows, rest = _split(large, classes)
            total = rows.count()
            if not rest.isEmpty():
                stuck.append(rest)
    if small:
        one = {"chunk": F.lit(0), "few": F.lit(1), "chunks": F.lit(1)}
        rows = reduce(DataFrame.unionByName, small).withColumns(one)
        if stuck:
            rows = rows.unionByName(join.blocks(reduce(DataFrame.unionByName, stuck), percent))
        join.compare_nodes(rows, percent)

    return _placed(sketches, classes, join.roots)


def _placed(sketches: DataFrame, classes: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Every row with its group's smallest id."""
    given = F.when(F.col("row_id") != NO_ID, F.col("row_id"))
    order = F.struct(F.col("row_id") == NO_ID, *KEY)
    own = classes.select(*CLASS, "node", "members", given.alias("least"), order.alias("head"))
    if roots is None:
        groups = own.withColumn("component_id", F.col("least"))
    elif roots.count() <= BROADCAST_ROWS:
        own = own.join(F.broadcast(roots), "node", "left")
        lowest = own.where("root is not null").groupBy("root")
        lowest = lowest.agg(F.min("least").alias("lowest"), F.min("head").alias("lowest_head"))
        groups = own.join(F.broadcast(lowest), "root", "left").withColumns(
            {"component_id": F.coalesce("lowest", "least"), "head": F.coalesce("lowest_head", "head")}
        )
    else:
        own = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        own = stored(own.drop("node"), "own")
        lowest = own.groupBy("root").agg(
            F.min("least").alias("component_id"), F.min("head").alias("lowest_head"), F.count("*").alias("n")
        )
        groups = with_lookup(own, lowest, ["root"], "n", own.count()).withColumn("head", F.col("lowest_head"))
    groups = groups.select(*CLASS, "members", "component_id", "head")
    total = classes.agg(F.coalesce(F.sum("members"), F.lit(0))).head()[0]
    shown = [*KEY, given.alias("doc_id"), "n_shingles", "component_id"]
    some = with_lookup(sketches.where("n_shingles > 0"), groups, CLASS, "members", total)
    none = sketches.where("n_shingles = 0").withColumn("component_id", given)
    result = some.select(*shown, (order == F.col("head")).alias("first"))
    result = result.unionByName(none.select(*shown, F.lit(True).alias("first")))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
