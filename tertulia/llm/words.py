"""Words and their hashes for whole Arrow batches at once, as numpy arrays.

Texts of a batch are laid end to end with a space between them, so that a single pass finds
every word. A word's hash is the difference of two prefix sums, brought back to position
zero by the inverse power: no loop over words or texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tertulia.functions.batches import BATCH_ROWS, bounded_batches  # noqa: F401

#: Words are runs of anything but blank and the controls 0x09 to 0x0D.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words are runs of ASCII letters, digits and everything beyond ASCII.
PLAIN = np.zeros(256, bool)
PLAIN[0x30:0x3A] = PLAIN[0x41:0x5B] = PLAIN[0x61:0x7B] = PLAIN[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: Texts are worked on in pieces of about so many bytes, which bounds a worker's memory.
PIECE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection that spreads every bit over all 64."""
    h = h ^ np.uint64(salt)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64), 0x5851F42D4C957F2D)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    found = []
    for base in (_BASE, inverse):
        factors = np.full(n + 1, base, np.uint64)
        factors[0] = 1
        found.append(np.cumprod(factors, dtype=np.uint64))
    return tuple(found)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n at least of the base and of its inverse, modulo 2^64."""
    return _powers(1 << max(20, int(n).bit_length()))


def windows(h: np.ndarray, first: np.ndarray, length) -> np.ndarray:
    """Hashes of the runs of `length` values of h that start at `first`."""
    up, down = powers(len(h))
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=sums[1:])
    return mix((sums[first + length] - sums[first]) * down[first])


@dataclass
class Words:
    """data: bytes of all texts; starts, ends: of each word in data; docs: the first word of
    each text and the end; texts: where each text starts in data, and the end."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    docs: np.ndarray
    texts: np.ndarray

    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        up, down = powers(len(self.data))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * up[: len(self.data)], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def counts(self) -> np.ndarray:
        return np.diff(self.docs)

    def starts_of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First word of every run of `length` words inside one text, and runs per text."""
        n = np.maximum(self.counts() - length + 1, 0)
        return spans(self.docs[:-1], n), n


def spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (n[0] of them), first[1], ..."""
    before = np.cumsum(n) - n
    return np.repeat(first - before, n) + np.arange(n.sum())


def split(texts: list[bytes], inside: np.ndarray = SPACED, lower: bool = False) -> Words:
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    if lower:
        data = LOWER[data]
    found = inside[data]
    edges = np.flatnonzero(found[1:] != found[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    at = np.concatenate([[1], 1 + np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))])
    return Words(data, starts, ends, np.searchsorted(starts, at), at)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [t or b"" for t in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def pieces(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of the batches with the texts as bytes, of about PIECE_BYTES, one row at least."""
    for batch in batches:
        texts = as_bytes(batch.column(text))
        first = size = 0
        for k, t in enumerate(texts):
            if k > first and size + len(t) > PIECE_BYTES:
                yield batch.slice(first, k - first), texts[first:k]
                first, size = k, 0
            size += len(t)
        if first < len(texts):
            yield batch.slice(first), texts[first:]
