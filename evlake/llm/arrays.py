"""Words and shingles of a batch of texts as numpy arrays.

A batch's texts lie one after the other in a byte buffer, so words are found and
hashed for all of them at once. Words are runs of anything but space and the ASCII
controls 9 to 13; A-Z count as a-z.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are worked on in slices of about so many bytes; a longer text is one slice.
SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.ones(256, bool)
_INSIDE[[9, 10, 11, 12, 13, 32]] = False

_ODD = 0x9E3779B97F4A7C55
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


@dataclass
class Words:
    """Words of some texts: byte ranges, 64-bit hashes, and each text's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    sums: np.ndarray

    def heads(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Words longer than ``size`` bytes, and the hashes of their first bytes."""
        which = np.flatnonzero(self.ends - self.starts > size)
        return which, _hashed(self.sums, self.starts[which], self.starts[which] + size, size)

    def text(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "replace")


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose texts have about SLICE_BYTES."""
    if not batch.num_rows:
        return
    _, offsets = texts_of(batch.column(column))
    piece = offsets[:-1] // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(a, b - a)


#: Bytes of letters: a-z, and everything beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[97:123] = LETTERS[128:] = True


def words_of(data: np.ndarray, offsets: np.ndarray, made_of: np.ndarray = _INSIDE) -> Words:
    """The words, runs of bytes that ``made_of`` marks."""
    low = _LOWER[data]
    inside = made_of[low]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    some = offsets[:-1] < offsets[1:]
    before[offsets[:-1][some]] = False
    after[offsets[1:][some] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _power_table(_ODD, len(low)), out=sums[1:])
    return Words(low, starts, ends, _hashed(sums, starts, ends), np.searchsorted(starts, offsets), sums)


def _hashed(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hashes of byte ranges. ``sums`` adds up byte * base^position; a difference of two
    sums times base^-start is the range's own polynomial, wherever it stands."""
    own = (sums[ends] - sums[starts]) * _power_table(_ODD_INVERSE, len(sums))[starts]
    length = (ends - starts).astype(np.uint64) + np.uint64(salt << 32)
    return mix(own + length * np.uint64(0xD6E8FEB86659FD93))


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words, and each text's first one.

    A text of fewer words has its whole sequence as the one shingle.
    """
    first, n = words.first, np.diff(words.first)
    k = np.where(n >= size, size, n)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    offsets = np.concatenate(([0], np.cumsum(count)))
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], count) + np.repeat(first[:-1], count)
    length = np.repeat(k, count)
    hashes = np.zeros(len(place), np.uint64)
    for i in range(size):
        more = length > i
        step = words.hashes[np.minimum(place + i, max(len(words.hashes) - 1, 0))] if len(place) else hashes
        hashes = np.where(more, mix(hashes * np.uint64(0x9FB21C651E98DF25) + step), hashes)
    return hashes, offsets


def sets_of(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes sorted, without repeats."""
    ordered = hashes.copy()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a > 1:
            ordered[a:b].sort()
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    some = offsets[:-1] < offsets[1:]
    fresh[offsets[:-1][some]] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))
    return ordered[fresh], kept[offsets]
