"""Token-id matrices packed by best fit, longest documents first.

A task takes its documents in blocks of bounded size. Those longer than a row are cut into full
rows and a rest, without loss. Pieces are placed in order of falling length, each into the row with
the least room that still holds it; a segment tree over the possible amounts of room finds it. A
row of the result is one row of the matrix: its ids, filled up, the cumulative lengths of its
segments, and positions that start again at each segment.

A null text is empty; documents without tokens have no piece, so they need the end mark if they
are to be seen. Repeated rows are packed once each. Other columns are not read. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalspan.llm.common import batch, documents, importable
from vitalspan.llm.pair_index_bpe import encoded_rows

#: Rows are numbered from the partition's number times this.
ROWS_PER_TASK = 1 << 33

#: Rows of the matrix that are handed over together.
ROWS_AT_ONCE = 128


class Rooms:
    """Segment tree over amounts of room 0 to ``size``: which of them some row has."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.there = [False] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.leaves
        while node and not self.there[node]:
            self.there[node] = True
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The least room of at least ``length``, and a row that has it."""
        there, node = self.there, length + self.leaves
        while not there[node]:
            # up to the first subtree on the right
            while node & 1:
                node >>= 1
                if node == 0:
                    return None
            node += 1
            if node & (node - 1) == 0:
                return None
        while node < self.leaves:
            node = 2 * node if there[2 * node] else 2 * node + 1
        room = node - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            there[node] = False
            node >>= 1
            while node and not (there[2 * node] or there[2 * node + 1]):
                there[node] = False
                node >>= 1
        return room, row


def fitted(lengths: np.ndarray, size: int) -> list[list[tuple[int, int, int]]]:
    """Pieces (document, start, length) of each row."""
    rows: list[list[tuple[int, int, int]]] = []
    rests = []
    for document, total in enumerate(lengths.tolist()):
        start = 0
        while total - start >= size:
            rows.append([(document, start, size)])
            start += size
        if total > start:
            rests.append((document, start, total - start))
    rooms = Rooms(size)
    for piece in sorted(rests, key=lambda p: (-p[2], p[0])):
        found = rooms.take(piece[2])
        if found:
            room, row = found
        else:
            room, row = size, len(rows)
            rows.append([])
        rows[row].append(piece)
        rooms.put(room - piece[2], row)
    return rows


SCHEMA = (
    "row_id long, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, ids binary, "
    "positions binary"
)


def _packed(path: str, end_id: int | None, pad_id: int, size: int) -> Callable:
    schema = pa.schema(
        [("row_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
         ("starts", pa.list_(pa.int64())), ("cu_seqlens", pa.list_(pa.int32())),
         ("ids", pa.binary()), ("positions", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * ROWS_PER_TASK
        for part in batches:
            keys = part.column(0).to_pylist()
            for a, b, ids, begins in encoded_rows(part.column(1), path):
                if end_id is not None:
                    # a mark after each document
                    ids = np.insert(ids, begins[1:], end_id)
                    begins = begins + np.arange(len(begins))
                rows = fitted(np.diff(begins), size)
                for at in range(0, len(rows), ROWS_AT_ONCE):
                    some = rows[at : at + ROWS_AT_ONCE]
                    matrix = np.full((len(some), size), pad_id, "<u4")
                    positions = np.zeros((len(some), size), "<u4")
                    lengths = []
                    for i, row in enumerate(some):
                        ends = np.cumsum([0] + [p[2] for p in row], dtype=np.int32)
                        for (document, start, length), offset in zip(row, ends.tolist()):
                            first = begins[document] + start
                            matrix[i, offset : offset + length] = ids[first : first + length]
                            positions[i, offset : offset + length] = np.arange(length)
                        lengths.append(ends)
                    yield batch(
                        schema,
                        [np.arange(number, number + len(some)),
                         [[keys[a + p[0]] for p in row] for row in some],
                         [[p[1] for p in row] for row in some], lengths,
                         [r.tobytes() for r in matrix], [r.tobytes() for r in positions]],
                    )
                    number += len(some)

    return run


def pack(
    docs: DataFrame, path: str, end_id: int | None = None, pad_id: int = 0, size: int = 2048
) -> DataFrame:
    """Rows of ``size`` ids (little-endian unsigned 32-bit numbers) with their segments.

    ``cu_seqlens`` begins with 0 and ends with the number of ids before the filling; segment k is
    document ``doc_ids[k]`` from its id ``starts[k]`` on. ``positions`` count within a segment.
    """
    importable(docs.sparkSession)
    return documents(docs).mapInArrow(_packed(path, end_id, pad_id, size), SCHEMA)


def write(packed: DataFrame, path: str) -> None:
    """The matrices as Parquet files, a row group's worth of rows each."""
    packed.write.mode("errorifexists").parquet(path)


def digests(packed: DataFrame) -> DataFrame:
    """Segments of packed rows, read back from the matrices, with checksums of ids and positions."""
    k = F.explode(F.sequence(F.lit(0), F.size("doc_ids") - 1)).alias("k")
    segments = packed.filter(F.size("doc_ids") > 0).select("*", k)
    begin, end = F.col("cu_seqlens")[F.col("k")], F.col("cu_seqlens")[F.col("k") + 1]
    part = lambda c: F.crc32(F.substr(c, 4 * begin + 1, 4 * (end - begin)))
    return segments.select(
        F.col("doc_ids")[F.col("k")].alias("doc_id"),
        F.col("starts")[F.col("k")].alias("start"),
        (end - begin).cast("long").alias("length"),
        "row_id",
        begin.cast("long").alias("offset"),
        part("ids").alias("ids_crc32"),
        part("positions").alias("positions_crc32"),
    )
