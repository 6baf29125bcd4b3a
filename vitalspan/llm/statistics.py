"""Counts of whole texts, vectorised over blocks of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa

from vitalspan.llm.common import row_blocks, text_buffer
from vitalspan.llm.hashing import mixed, range_hashes, words

NAMES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks",
    "n_lines", "n_digits", "n_distinct_words", "n_stops",
]

_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False


def _table(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_SYMBOLS, _MARKS, _DIGITS = _table(b"#*$%&|<>"), _table(b"!?"), _table(b"0123456789")
_STOPS, _CAPITALS = _table(b".,;:"), _table(bytes(range(65, 91)))
_MANY = np.uint64(0x9FB21C651E98DF25)


def _block(offsets: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return np.diff(sums[offsets])

    def by_row(rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=n).astype(np.int64)

    solid = _SOLID[data]
    starts, ends, rows = words(offsets, data)
    hashes = range_hashes(data, starts, ends) + rows.astype(np.uint64) * _MANY
    out = {
        "n_words": by_row(rows),
        "word_chars": total(solid & ((data & 0xC0) != 0x80)),
        "n_symbols": total(_SYMBOLS[data]),
        "n_marks": total(_MARKS[data]),
        "n_digits": total(_DIGITS[data]),
        "n_stops": total(_STOPS[data]),
    }
    upper = _CAPITALS[data]
    # capitals of Latin-1: 0xC3 and 0x80 to 0x9E but the sign of multiplication
    upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out["n_upper"] = total(upper)
    out["n_distinct_words"] = by_row(rows[~pd.Index(mixed(hashes)).duplicated()])

    # lines with a word, told apart within their text
    feed = data == 10
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:] |= feed
    begin = np.flatnonzero(edge[:-1])
    end = np.concatenate((begin[1:], [len(data)]))
    end = end - ((end > begin) & feed[np.maximum(end - 1, 0)]) if len(begin) else end
    seen = np.concatenate(([0], np.cumsum(solid)))
    wordy = seen[end] > seen[begin]
    begin, end = begin[wordy], end[wordy]
    row = np.searchsorted(offsets, begin, side="right") - 1
    keys = mixed(range_hashes(data, begin, end) + row.astype(np.uint64) * _MANY)
    out["n_lines"] = by_row(row)
    out["n_dup_lines"] = by_row(row[pd.Index(keys).duplicated()])

    # words in windows of three that the text has twice or more
    covered = np.zeros(len(rows), bool)
    if len(rows) >= 3:
        inside = rows[:-2] == rows[2:]
        window = mixed(hashes[:-2] * np.uint64(3) + mixed(hashes[1:-1]))
        window = mixed(window + hashes[2:] * np.uint64(0xD1342543DE82EF95))
        at = np.flatnonzero(inside)
        again = at[pd.Index(window[at]).duplicated(keep=False)]
        for k in range(3):
            covered[again + k] = True
    out["n_repeat_words"] = by_row(rows[covered])
    return out


def text_statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text of a string column; those of a null are zero."""
    offsets, data = text_buffer(column)
    parts = [
        _block(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
        for a, b in row_blocks(offsets)
    ]
    return {k: np.concatenate([p[k] for p in parts] or [np.zeros(0, np.int64)]) for k in NAMES}
