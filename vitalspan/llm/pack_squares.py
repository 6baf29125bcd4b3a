"""Online packing by sums of squares.

Each task takes its documents in order. A document goes to the fill level that makes the sum of
the squared counts of partly filled windows least; a level array counts the windows at each level.
Full windows' worth of a longer document is cut off first. When a task's documents end, its partly
filled windows are closed: pieces of the emptiest windows are cut to fill up the fullest ones, and
what remains is laid out in windows whose lengths are powers of two, which need no padding.

A null text is empty, so that the document is its end mark alone. Repeated rows are packed once
each. Other columns are not read. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from vitalspan.llm.common import batch, documents, importable
from vitalspan.llm.pair_index_bpe import encoded_rows

#: A task numbers its windows from its partition's number times this.
WINDOWS_PER_TASK = 1 << 33


class Packer:
    """Windows of ``size`` tokens. A piece is (document, start, length)."""

    def __init__(self, size: int):
        self.size = size
        self.open: list[list[list[tuple]]] = [[] for _ in range(size + 1)]
        self.counts = np.zeros(size + 1, np.int64)

    def place(self, document: int, start: int, length: int) -> list[tuple] | None:
        """Adds a piece of at most ``size``; the window if that fills it.

        Moving a window from level h to h + length changes the sum of squares by
        2 (count[h + length] - count[h]) + 2. A full window and an unopened one count nothing.
        Of equal levels the fullest is taken.
        """
        gain = np.empty(self.size - length + 1, np.int64)
        gain[0] = 1
        gain[1:] = 2 - 2 * self.counts[1 : self.size - length + 1]
        gain += 2 * self.counts[length : self.size + 1]
        gain[-1] -= 1  # the window is full, so no level gains it
        there = self.counts[: self.size - length + 1] > 0
        there[0] = True
        gain[~there] = np.iinfo(np.int64).max
        level = len(gain) - 1 - int(np.argmin(gain[::-1]))
        window = self.open[level].pop() if level else []
        self.counts[level] -= level > 0
        window.append((document, start, length))
        if level + length == self.size:
            return window
        self.open[level + length].append(window)
        self.counts[level + length] += 1
        return None

    def close(self) -> Iterator[list[tuple]]:
        """Full windows made of all that is open, then windows of lengths that are powers of two."""
        rest = [w for level in reversed(self.open) for w in level]
        spare: list[tuple] = []
        low = len(rest) - 1

        def take(most: int) -> tuple:
            document, start, length = spare.pop()
            if length > most:
                spare.append((document, start + most, length - most))
            return document, start, min(length, most)

        high = 0
        while high <= low:
            window, room = rest[high], self.size - sum(p[2] for p in rest[high])
            while room and (spare or low > high):
                if not spare:
                    spare = rest[low]
                    low -= 1
                    continue
                window.append(take(room))
                room -= window[-1][2]
            high += 1
            if room == 0:
                yield window
            else:
                spare = window
        left = sum(p[2] for p in spare)
        while left:
            room = min(self.size, 1 << (left.bit_length() - 1))
            left -= room
            window = []
            while room:
                window.append(take(room))
                room -= window[-1][2]
            yield window


FIELDS = [
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
]


def _pieces(path: str, end_id: int, size: int, keep: bool) -> Callable:
    schema = pa.schema(FIELDS + ([("ids", pa.binary())] if keep else []))
    mark = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(size)
        number = TaskContext.get().partitionId() * WINDOWS_PER_TASK
        texts: dict[int, list] = {}  # id, ids as bytes, tokens not yet given out
        rows: list[list] = [[] for _ in schema]

        def give(window: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for document, start, length in window:
                entry = texts[document]
                own = entry[1][4 * start : 4 * (start + length)]
                values = [entry[0], start, length, zlib.crc32(own), len(entry[1]) // 4, number,
                          offset]
                for column, value in zip(rows, values + [own] * keep):
                    column.append(value)
                offset += length
                entry[2] -= length
                if not entry[2]:
                    del texts[document]
            number += 1

        def out() -> pa.RecordBatch:
            made = batch(schema, rows)
            for column in rows:
                column.clear()
            return made

        serial = 0
        for part in batches:
            keys = part.column(0).to_pylist()
            for a, b, ids, begins in encoded_rows(part.column(1), path):
                raw, where = ids.astype("<u4").tobytes(), begins.tolist()
                for i in range(a, b):
                    own = raw[4 * where[i - a] : 4 * where[i - a + 1]] + mark
                    total = len(own) // 4
                    texts[serial] = [keys[i], own, total]
                    start = 0
                    while total - start > size:
                        give([(serial, start, size)])
                        start += size
                    full = packer.place(serial, start, total - start)
                    if full:
                        give(full)
                    serial += 1
                yield out()
        for window in packer.close():
            give(window)
        yield out()

    return run


def pack(
    docs: DataFrame, path: str, end_id: int = 1, size: int = 2048, with_ids: bool = True
) -> DataFrame:
    """Pieces of all documents in windows of at most ``size`` tokens: where each lies, its ids.

    A document's tokens are its ids by the vocabulary file ``path`` and ``end_id``. A task holds
    the ids of the documents in its open windows. Sums of squares keep these few, as they favour
    moves that fill levels unevenly used, and a task's share of the input bounds them.
    """
    importable(docs.sparkSession)
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long" + (", ids binary" if with_ids else "")
    )
    return documents(docs).mapInArrow(_pieces(path, end_id, size, with_ids), schema)
