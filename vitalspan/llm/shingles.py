"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from vitalspan.llm.common import row_blocks, text_buffer
from vitalspan.llm.hashing import LOWER_VALUES, mixed, range_hashes, words

_STEP = np.uint64(0xD1342543DE82EF95)


def _sequence(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` consecutive word hashes."""
    n = len(hashes) - length + 1
    out = np.full(n, length, np.uint64)
    for k in range(length):
        out = mixed(out * _STEP + hashes[k : k + n])
    return out


def shingle_sets(
    offsets: np.ndarray, data: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted within it, and where each text's begin.

    A-Z count as a-z. A text of fewer than ``size`` words, but one at least, is one shingle.
    """
    n = len(offsets) - 1
    starts, ends, rows = words(offsets, data)
    hashes = range_hashes(data, starts, ends, LOWER_VALUES)
    many = np.bincount(rows, minlength=n)
    found, of = [], []
    if len(hashes) >= size:
        inside = np.flatnonzero(rows[: len(rows) - size + 1] == rows[size - 1 :])
        found.append(_sequence(hashes, size)[inside])
        of.append(rows[inside])
    first = np.concatenate(([0], np.cumsum(many)))
    for length in range(1, size):
        short = np.flatnonzero(many == length)
        if len(short):
            found.append(_sequence(hashes, length)[first[short]])
            of.append(short)
    shingles = np.concatenate([np.zeros(0, np.uint64), *found])
    rows = np.concatenate([np.zeros(0, np.int64), *of])
    order = np.argsort(shingles)
    small = rows[order].astype(np.uint16 if n < 1 << 16 else np.int64)
    order = order[np.argsort(small, kind="stable")]
    shingles, rows = shingles[order], rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (rows[1:] != rows[:-1])
    shingles, rows = shingles[new], rows[new]
    return shingles, np.searchsorted(rows, np.arange(n + 1))


def set_blocks(
    column: pa.Array, size: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, shingles and bounds, for runs of rows of bounded size."""
    offsets, data = text_buffer(column)
    for a, b in row_blocks(offsets):
        lo, hi = offsets[a], offsets[b]
        yield a, b, *shingle_sets(offsets[a : b + 1] - lo, data[lo:hi], size)


def set_key(shingles: np.ndarray) -> int:
    """A signed 64-bit key of a set of shingles."""
    digest = hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)
