"""Benchmark decontamination by q-gram lemma filtering.

A passage of m characters that occurs in a text with at most k edits shares at least
m - q + 1 - k * q of its q-grams with it, on diagonals (position in the text minus
position in the passage) that lie no more than k apart. So shared q-grams are counted
in overlapping bands of diagonals; a region that reaches the bound is kept and verified
by a banded alignment, and everything else provably holds no such occurrence.

Case of A-Z and runs of white space do not count. The budget k is ``EDIT_PERCENT`` of
the passage's length, less where the bound would fall below one q-gram. Passages under
``Q`` characters have no q-gram and are not looked for.

The passages go to the tasks in chunks of at most ``CHUNK_CHARS`` characters, one pass
over the documents each, so that what a task holds does not grow with the benchmark.
Documents are read where they are; nothing is shuffled.

Defined results: null texts and passages count as empty, and empty ones are never
found; equal passages are reported under each of their ids; a document repeated is
judged each time. An empty benchmark leaks nowhere.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evlake.llm.arrays import slices, texts_of
from evlake.llm.common import whole

#: Characters of a q-gram, a power of two.
Q = 8
#: Of the shorter q-grams that regions are filtered by once more.
SHORT_Q = 4
EDIT_PERCENT = 10
#: Characters of passages a task holds at once, and the longest passage they may have.
CHUNK_CHARS = 4_000_000

_BASE = 0x9E3779B97F4A7C55
_TABLE_BITS = 20
_END = 0x110000  # between texts; no character


def _characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised characters of all texts, each text's first one, and for every
    character its position in the text before normalising."""
    text = data.tobytes().decode("utf-8", "replace")
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    leading = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    at = leading[offsets]
    # One end mark after each text.
    n = len(offsets) - 1
    place = np.arange(len(chars)) + np.repeat(np.arange(n), np.diff(at))
    marked = np.full(len(chars) + n, _END, np.uint32)
    marked[place] = chars
    marked[(marked >= 65) & (marked <= 90)] += 32
    blank = (marked == 32) | ((marked >= 9) & (marked <= 13))
    marked[blank] = 32
    keep = np.ones(len(marked), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    first = at + np.arange(n + 1)
    position = np.arange(len(marked)) - np.repeat(first[:-1], np.diff(first))
    kept = np.concatenate(([0], np.cumsum(keep)))
    return marked[keep], kept[first], position[keep]


def _grams(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the ``q`` characters from each position."""
    h, n, base = chars.astype(np.uint64), 1, _BASE
    while n < q:
        h = h[:-n] * np.uint64(base) + h[n:] if len(h) > n else h[:0]
        n, base = 2 * n, base * base % 2**64
    return h * np.uint64(_BASE)


class _Passages:
    """A chunk of passages and the index of their q-grams."""

    def __init__(self, ids: list[int], texts: list[str]):
        joined = [t.encode() for t in texts]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in joined]))).astype(np.int64)
        chars, first, _ = _characters(np.frombuffer(b"".join(joined), np.uint8), offsets)
        self.ids, self.chars, gram, item, place = ids, [], [], [], []
        for i in range(len(ids)):
            own = chars[first[i] : first[i + 1] - 1]
            own = own[1:] if len(own) and own[0] == 32 else own
            own = own[:-1] if len(own) and own[-1] == 32 else own
            self.chars.append(own)
            g = _grams(own)
            gram.append(g)
            item.append(np.full(len(g), i))
            place.append(np.arange(len(g)))
        lengths = np.array([len(c) for c in self.chars], np.int64)
        self.budget = np.minimum(lengths * EDIT_PERCENT // 100, np.maximum(0, lengths - Q) // Q)
        self.bound = lengths - Q + 1 - self.budget * Q
        self.short = [_grams(own, SHORT_Q) for own in self.chars]
        gram, item, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (gram, item, place))
        order = np.argsort(gram, kind="stable")
        self.item, self.place = item[order], place[order]
        self.gram, self.at = np.unique(gram[order], return_index=True)
        self.at = np.append(self.at, len(gram))
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.gram.astype(np.uint64) >> np.uint64(64 - _TABLE_BITS)] = True

    def regions(self, chars: np.ndarray) -> Iterator[tuple[int, int]]:
        """Passage and lowest diagonal of every band that reaches the bound."""
        grams = _grams(chars)
        here = np.flatnonzero(self.table[grams >> np.uint64(64 - _TABLE_BITS)])
        if not len(here) or not len(self.gram):
            return
        found = np.searchsorted(self.gram, grams[here])
        same = self.gram[np.minimum(found, len(self.gram) - 1)] == grams[here]
        here, found = here[same], found[same]
        count = self.at[found + 1] - self.at[found]
        each = np.repeat(self.at[found], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        item, diagonal = self.item[each], np.repeat(here, count) - self.place[each]
        budget = self.budget[item]
        band = diagonal // (budget + 1)
        # A band also takes the first k diagonals of the next, so any k + 1 diagonals
        # in a row lie in one band.
        also = (diagonal - band * (budget + 1) < budget) & (budget > 0)
        item = np.concatenate((item, item[also]))
        band = np.concatenate((band, band[also] - 1))
        key = item * (1 << 40) + (band + (1 << 39))
        key, shared = np.unique(key, return_counts=True)
        for k in key[shared >= self.bound[key >> 40]].tolist():
            i = k >> 40
            yield i, ((k & ((1 << 40) - 1)) - (1 << 39)) * int(self.budget[i] + 1)


def align(passage: np.ndarray, text: np.ndarray, low: int, high: int, anywhere: bool = True) -> tuple[int, int]:
    """Fewest edits that turn ``passage`` into a piece of ``text``, and the piece's end.

    Only diagonals ``low`` to ``high`` are filled in; the piece may start anywhere on
    them, or unless ``anywhere`` at the text's start.
    """
    m, width = len(passage), high - low + 1
    far = m + width + 1
    step = np.arange(width)
    end = step + low  # position in the text after 0 characters of the passage
    cost = np.where((end >= 0) & (end <= len(text)), 0 if anywhere else end, far)
    padded = np.full(m + 2 * width + abs(low) + len(text) + 2, _END + 1, np.uint32)
    shift = width + abs(low)
    padded[shift : shift + len(text)] = text
    for r in range(m):
        # cost[d]: passage[:r] against the text up to r + low + d
        here = padded[shift + low + r : shift + low + r + width]
        fresh = cost + (here != passage[r])
        fresh[:-1] = np.minimum(fresh[:-1], cost[1:] + 1)
        at = end + r + 1
        fresh[(at < 0) | (at > len(text))] = far
        cost = np.minimum.accumulate(fresh - step) + step
        cost[(at < 0) | (at > len(text))] = far
    best = int(np.argmin(cost))
    return int(cost[best]), int(end[best] + m)


def _verify(own: _Passages, i: int, text: np.ndarray, low: int) -> tuple[int, int, int] | None:
    """Edits, start and end of passage ``i`` on the band from diagonal ``low``."""
    k, passage = int(own.budget[i]), own.chars[i]
    start = max(0, low - k)
    piece = text[start : max(0, low + 2 * k + len(passage) + k + 1)]
    exact = piece.tobytes().find(passage.tobytes())
    while exact >= 0 and exact % 4:
        exact = piece.tobytes().find(passage.tobytes(), exact + 1)
    if exact >= 0:
        return 0, start + exact // 4, start + exact // 4 + len(passage)
    # The lemma again, with q-grams that would be too frequent to look up everywhere.
    shared = int(np.isin(own.short[i], _grams(piece, SHORT_Q)).sum())
    if shared < len(passage) - SHORT_Q + 1 - k * SHORT_Q:
        return None
    edits, end = align(passage, piece, low - start - k, low - start + 3 * k)
    if edits > k:
        return None
    _, back = align(passage[::-1], piece[:end][::-1], -k, k, anywhere=False)
    return edits, start + end - back, start + end


def _leaks(own: _Passages, batch: pa.RecordBatch) -> dict[tuple[int, int], tuple[int, int, int]]:
    """Best occurrence by row of the batch and passage."""
    chars, first, position = _characters(*texts_of(batch.column("text")))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for i, low in own.regions(chars):
        # The band's q-grams start in the text that holds its middle.
        middle = min(max(low + len(own.chars[i]) // 2, 0), len(chars) - 1)
        row = int(np.searchsorted(first, middle, "right")) - 1
        a, b = int(first[row]), int(first[row + 1]) - 1
        found = _verify(own, i, chars[a:b], low - a)
        if found and found < best.get((row, i), (len(chars), 0, 0)):
            best[row, i] = found
    for (row, i), (edits, s, e) in best.items():
        a = int(first[row])
        best[row, i] = edits, int(position[a + s]), int(position[a + e - 1]) + 1
    return best


def _chunks(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[_Passages]:
    """The benchmark's passages, a bounded number of characters at a time."""
    text = whole(text_column)
    sized = benchmark.select(F.col(id_column).alias("id"), text.alias("text")).where(F.char_length("text") >= Q)
    total = sized.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).head()[0]
    parts = 2 * total // CHUNK_CHARS + 1
    for part in range(parts):
        rows = sized.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).collect()
        if rows:
            yield _Passages([r.id for r in rows], [r.text for r in rows])


def _finds(own: _Passages) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for whole_batch in batches:
            for batch in slices(whole_batch, "text"):
                rows = sorted(_leaks(own, batch).items())
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array([r for (r, _), _ in rows])),
                            pa.array([own.ids[i] for (_, i), _ in rows], pa.int64()),
                            *[pa.array([x[j] for _, x in rows], pa.int64()) for j in range(3)],
                        ],
                        ["doc_id", "item_id", "edits", "start", "end"],
                    )

    return run


FOUND = "doc_id long, item_id long, edits long, start long, end long"


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Each document and passage found in it: the occurrence of fewest edits, the
    first of equals, as character positions of the document's text."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    parts = [texts.mapInArrow(_finds(own), FOUND) for own in _chunks(benchmark, item_column, item_text)]
    if not parts:
        return docs.sparkSession.createDataFrame([], FOUND)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents in which no passage of the benchmark is found, all columns kept."""

    def clean(own: _Passages):
        def run(batches):
            for whole_batch in batches:
                for batch in slices(whole_batch, text_column):
                    named = pa.RecordBatch.from_arrays([batch.column(text_column)], ["text"])
                    bad = {row for row, _ in _leaks(own, named)}
                    yield batch.filter(pa.array([r not in bad for r in range(batch.num_rows)], pa.bool_()))

        return run

    for own in _chunks(benchmark, "item_id", "text"):
        docs = docs.mapInArrow(clean(own), docs.schema)
    return docs
