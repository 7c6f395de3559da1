"""Words, lines and hashes of an Arrow column of texts, without a loop over texts.

A task reads its Arrow batch in slabs of a megabyte, so its memory does not
depend on the size of a batch; a text longer than a slab is a slab of its own.
Words are runs of bytes other than 0x20 and 0x09-0x0D, which in UTF-8 are never
part of a longer character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLAB_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CONTINUES = (np.arange(256) & 0xC0) == 0x80


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class _Powers:
    """Powers of the base of byte polynomials and of its inverse, shared by all seeds."""

    BASE = 0x8A4B5C6D7E8F9A0B

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > SLAB_BYTES + 1:  # a very long text has its own, which go with it
            return self._made(n)
        if len(self.up) < n:
            self.up, self.down = self._made(SLAB_BYTES + 1)
        return self.up, self.down

    def _made(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        both = [np.full(n, b, np.uint64) for b in (self.BASE, pow(self.BASE, -1, 1 << 64))]
        for powers in both:
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)
        return both[0], both[1]


_POWERS = _Powers()


class _Polynomial:
    """Byte values, a salt and a base for windows of words; a seed fixes them."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.values = random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(random.integers(1, 2**61)) * 8 + 3
        self.salt = np.uint64(random.integers(1, 2**63))


_POLYNOMIALS: dict[int, _Polynomial] = {}


def _polynomial(seed: int) -> _Polynomial:
    if seed not in _POLYNOMIALS:
        _POLYNOMIALS[seed] = _Polynomial(seed)
    return _POLYNOMIALS[seed]


@dataclass
class Slab:
    """Neighbouring rows of a batch: their bytes and where each row begins and ends."""

    first_row: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def per_row(self, positions: np.ndarray) -> np.ndarray:
        """How many of the ascending positions lie in each row."""
        return np.searchsorted(positions, self.ends) - np.searchsorted(positions, self.starts)

    def total(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each row."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.ends] - sums[self.starts]

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of marked bytes, cut at row ends: first byte, byte after the last, row."""
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        some = self.starts < self.ends
        begins[self.starts[some]] = inside[self.starts[some]]
        stops[self.ends[some] - 1] = inside[self.ends[some] - 1]
        first = np.flatnonzero(begins)
        return first, np.flatnonzero(stops) + 1, np.repeat(np.arange(len(self)), self.per_row(first))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.spans(~_SPACE[self.data])

    def hashes(self, first: np.ndarray, last: np.ndarray, seed: int = 1, lower: bool = False) -> np.ndarray:
        """64-bit hashes of byte spans; ``lower`` takes A-Z as a-z."""
        poly = _polynomial(seed)
        up, down = _POWERS.first(len(self.data) + 1)
        values = poly.values[_LOWER] if lower else poly.values
        sums = np.empty(len(self.data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[self.data] * up[: len(self.data)], out=sums[1:])
        return mix((sums[last] - sums[first]) * down[first] + poly.salt * (last - first).astype(np.uint64))

    def code_points(self) -> np.ndarray:
        """1 for each byte that begins a character."""
        return ~_CONTINUES[self.data]

    def text(self, first: int, last: int) -> bytes:
        return self.data[first:last].tobytes()


def slabs(column: pa.Array, limit: int = SLAB_BYTES) -> Iterator[Slab]:
    """The rows of a string column in order; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        at = offsets[row : upto + 1] - offsets[row]
        yield Slab(row, data[offsets[row] : offsets[upto]], at[:-1], at[1:])
        row = upto


def windows(row: np.ndarray, width: int) -> np.ndarray:
    """Indexes of the words at which ``width`` words of one row begin."""
    if len(row) < width:
        return np.zeros(0, np.int64)
    return np.flatnonzero(row[: len(row) - width + 1] == row[width - 1 :])


def window_hashes(words: np.ndarray, at: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Rabin-Karp hashes of the windows beginning at ``at`` over word hashes."""
    base = np.uint64(_polynomial(seed).base)
    value = np.zeros(len(at), np.uint64)
    for step in range(width):
        value = value * base + words[at + step]
    return mix(value)
