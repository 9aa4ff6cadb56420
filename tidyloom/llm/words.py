"""Words of many texts at once, as numpy arrays: places in the bytes and 64-bit hashes.

Texts come as UTF-8 bytes. A word's hash is a polynomial over its bytes modulo
2**64, mixed at the end; all words of a chunk are hashed by one running sum.
Two different words share a hash with a chance of about 2**-60.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes of text that are hashed at once: with their powers, about 60 bytes of arrays for each.
_CHUNK = 1 << 18
#: Powers of so many places stay in a process at most.
_KEPT = 1 << 22

# A-Z become a-z; the bytes between words become spaces.
BLANK_SEPARATED = bytes(32 if b in b"\x20\x09\x0a\x0b\x0c\x0d" else b + 32 if 65 <= b <= 90 else b for b in range(256))
ALNUM_SEPARATED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(blobs: list[bytes], limit: int = _CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes; a longer text is a range of its own."""
    first, held = 0, 0
    for i, blob in enumerate(blobs):
        if held and held + len(blob) > limit:
            yield first, i
            first, held = i, 0
        held += len(blob) + 1
    if first < len(blobs):
        yield first, len(blobs)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches of the same rows: Python objects are made for so many rows at once."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def give_back() -> None:
    """Return freed memory to the system: the worker that has run a task goes on to others, or waits beside them."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # there is nothing to call where the C library is another one
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function over batches, which gives back at a task's end what the task has held."""

    def to_the_end(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return to_the_end


class _Powers:
    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            # Doubled, so that it is not made again for each text a little longer.
            size = max(1 << (n - 1).bit_length(), _CHUNK * 2) if n <= _KEPT else n
            up, down = np.full(size, _BASE), np.full(size, _INVERSE)
            up[0] = down[0] = 1
            up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
            if size > _KEPT:  # a very long text: do not keep its tables
                return up[:n], down[:n]
            cls.up, cls.down = up, down
        return cls.up[:n], cls.down[:n]


def running_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``sums`` and ``down`` so that bytes s to e hash to ``(sums[e] - sums[s]) * down[s]``."""
    up, down = _Powers.of(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums, down


class Words:
    """The words of a few texts: bytes, start and end places, and for each text its range of words."""

    def __init__(self, blobs: list[bytes], table: bytes = BLANK_SEPARATED):
        self.data = b" ".join(blobs).translate(table)
        self.bytes = np.frombuffer(self.data, dtype=np.uint8)
        blank = np.concatenate(([True], self.bytes == 32, [True]))
        self.starts = np.flatnonzero(blank[:-1] & ~blank[1:])
        self.ends = np.flatnonzero(~blank[:-1] & blank[1:])
        lengths = np.fromiter((len(b) + 1 for b in blobs), dtype=np.int64, count=len(blobs))
        self.places = np.concatenate(([0], np.cumsum(lengths)))
        self.ranges = np.searchsorted(self.starts, self.places)

    def hashes(self) -> np.ndarray:
        sums, down = running_hash(self.bytes)
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]]


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; a shorter, not empty text is one run."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    out = hashes[: len(hashes) - size + 1].copy()
    for i in range(1, size):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : len(hashes) - size + 1 + i])
    return out
