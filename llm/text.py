"""Words, lines and rolling hashes of Arrow text batches, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 20  # bytes of text that are looked at together

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_RANDOM = np.random.default_rng(0x5EED)
_BYTE = _RANDOM.integers(0, 2**64, 256, np.uint64)
BASE = 0x9E3779B97F4A7C15
WORD_BASES = (0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7)


class Text(NamedTuple):
    """Rows of one slice: their batch, the UTF-8 bytes, and where each row begins."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Byte ranges of words, the row of each, and a 64-bit hash."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    hash: np.ndarray


def give_back() -> None:
    """Returns the memory of freed batches, which an idle worker would go on holding."""
    pa.default_memory_pool().release_unused()


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE
) -> Iterator[Text]:
    """Row ranges of about ``limit`` bytes of text; a longer row comes alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = batch.column(column).cast(pa.large_string()).fill_null("")
        ends = np.frombuffer(sizes.buffers()[1], np.int64)
        ends = ends[sizes.offset : sizes.offset + len(sizes) + 1]
        body = sizes.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + limit, "right")) - 1
            to = max(at + 1, min(to, batch.num_rows))
            yield Text(
                batch.slice(at, to - at),
                data[ends[at] : ends[to]],
                ends[at : to + 1] - ends[at],
            )
            at = to
    give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    held = _POWERS.get(base)
    if held is None or len(held[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        held = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= 1 << 23:
            _POWERS[base] = held
    return held


class Rolling:
    """Hashes of any range of a sequence, from one running sum (modulo 2^64)."""

    def __init__(self, values: np.ndarray, base: int = BASE) -> None:
        up, self.down = _powers(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        body = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(body + (ends - starts).astype(np.uint64))

    def fixed(self, n: int) -> np.ndarray:
        """Of every run of n values."""
        count = len(self.sums) - n
        if count <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[n:] - self.sums[:-n]) * self.down[:count] + np.uint64(n))


def rolling_bytes(data: np.ndarray) -> Rolling:
    return Rolling(_BYTE[data])


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; every other byte stays."""
    return _LOWER[data]


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def words(data: np.ndarray, offsets: np.ndarray, hashed: bool = True) -> Words:
    """Runs of bytes other than space and 0x09-0x0D; they never cross rows."""
    n = len(data)
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:n]
    finishes = solid.copy()
    finishes[:-1] &= ~solid[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    hashes = rolling_bytes(data).of(starts, ends) if hashed else None
    return Words(starts, ends, row, hashes)


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each row are flagged."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the keys that are there twice or more, and of those not for the first time."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    every, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    every[order[:-1][same]] = True
    return every | later, later


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Flags of the n places that lie in [start, start + width) of any start."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:-1]) > 0
