"""Exact substring dedup by Rabin-Karp hashes of every window of words.

Every window of consecutive words of a text gets a rolling hash. Spark deals the hashes over ranges,
and within a range equal ones are counted: all but the first occurrence, by document and start,
repeat something earlier. The starts of repeating windows return to their documents, where
overlapping and adjacent windows merge into maximal intervals of words, which are removed.

Windows travel packed, one row for a block of texts and a range, in columns of bytes, which are some
eleven bytes a window. Of windows that are equal within a block only the first travels, so a passage
that all documents share brings a range no more than one entry a block. Ranges grow in number with
the input, so that each holds about as many windows at any size.

Hashes have 64 bits. Two different windows of n share one with probability n * n / 2 ** 65: 0.0005 for
the 130 million windows of half a GB of Parquet.

Null and empty texts and those shorter than a window lose nothing. Rows without an id come first, in
the order of a hash of their text. Rows that share an id, or a text without one, are one document
whose texts begin at the same place: a window is earlier than an equal one that starts further on in
any of them, and those at the same start don't remove each other, so that equal rows all keep the
same. Very long texts form a block of their own. Other columns are not read. An empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalspan.llm.common import (
    batch,
    documents,
    importable,
    row_blocks,
    text_buffer,
    with_filter,
    written,
)
from vitalspan.llm.hashing import mixed, range_hashes, words

#: Text whose windows are sent off together; it is hashed in smaller parts.
BLOCK_BYTES = 4 << 20

#: Text for which a range of hashes is made; some 20 bytes of memory for each byte of it.
RANGE_BYTES = 8 << 20

#: Tasks that the ranges are dealt over, as long as there are as many ranges.
MOST_TASKS = 20_000

#: Rows without an id get numbers from here on.
LEAST_ID = -(1 << 63)

#: The half of a hash that returns with a window.
LOW = np.uint64((1 << 32) - 1)

_BASE = 0xBF58476D1CE4E5B9
_INVERSE = pow(_BASE, -1, 1 << 64)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rolling hashes of each run of ``size`` word hashes, from sums of powers of one base."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    steps = np.full(n, _BASE, np.uint64)
    steps[0] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * np.cumprod(steps), out=sums[1:])
    steps[1:] = _INVERSE
    return mixed((sums[size:] - sums[:-size]) * np.cumprod(steps)[: n - size + 1])


def windows(
    offsets: np.ndarray, data: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and start (words before it) of each window of texts laid end to end."""
    starts, ends, rows = words(offsets, data)
    hashes = window_hashes(range_hashes(data, starts, ends), size)
    whole = np.flatnonzero(rows[: len(hashes)] == rows[size - 1 :]) if len(hashes) else hashes
    whole = whole.astype(np.int64)
    first = np.searchsorted(rows, np.arange(len(offsets) - 1))
    rows = rows[whole]
    return hashes[whole], rows, (whole - first[rows]).astype(np.uint32)


def planes(values: np.ndarray) -> bytes:
    """Numbers with their first bytes together, then the second and so on, which compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def numbers(raw: bytes, kind: str) -> np.ndarray:
    """What ``planes`` was given."""
    wide = np.dtype(kind).itemsize
    own = np.frombuffer(raw, np.uint8).reshape(wide, -1)
    return np.ascontiguousarray(own.T).view(kind).ravel()


def later(hashes: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks: windows with an equal one earlier, and the first window of each hash."""
    first = np.ones(len(hashes), bool)
    repeats = np.zeros(len(hashes), bool)
    order = np.argsort(hashes)
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    shared = np.zeros(len(hashes), bool)
    shared[1:] |= same
    shared[:-1] |= same
    # only windows that share their hash have to be put in order
    order = order[shared]
    if len(order):
        order = order[np.lexsort((starts[order], docs[order], hashes[order]))]
        ordered = hashes[order]
        new = np.append(True, ordered[1:] != ordered[:-1])
        heads = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        first[order] = new
        repeats[order] = (docs[order] != docs[heads]) | (starts[order] != starts[heads])
    return repeats, first


_PACKED = pa.schema(
    [("place", pa.int64()), ("decided", pa.bool_()), ("hashes", pa.binary()), ("docs", pa.binary()),
     ("starts", pa.binary())]
)
_REPEATED = pa.schema([("doc", pa.int64()), ("place", pa.int64())])


def _packed(size: int, bits: int) -> Callable:
    """Rows of one range and block. Decided ones are known to repeat a window of their block."""

    def row(place: int, decided: bool, own: tuple, chosen: np.ndarray) -> tuple:
        hashes, docs, starts = (x[chosen] for x in own)
        steps = np.diff(docs, prepend=np.int64(0))
        return place, decided, planes(hashes), planes(steps), planes(starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            keys = part.column(0).to_numpy()
            offsets, data = text_buffer(part.column(1))
            for a, b in row_blocks(offsets, BLOCK_BYTES):
                parts = []
                for c, d in row_blocks(offsets[a : b + 1]):
                    lo, hi = offsets[a + c], offsets[a + d]
                    hashes, rows, starts = windows(offsets[a + c : a + d + 1] - lo, data[lo:hi], size)
                    parts.append((hashes, keys[a + c : a + d][rows], starts))
                own = tuple(np.concatenate(x) for x in zip(*parts))
                if not len(own[0]):
                    continue
                repeats, first = later(*own)
                places = own[0] >> np.uint64(64 - bits) if bits else own[0] * np.uint64(0)
                places = places.astype(np.int64)
                first = np.flatnonzero(first)
                first = first[np.argsort(places[first], kind="stable")]
                cuts = np.flatnonzero(np.diff(places[first])) + 1
                made = [row(int(places[c[0]]), False, own, c) for c in np.split(first, cuts)]
                again = np.flatnonzero(repeats)
                if len(again):
                    made.append(row(int(places[again[0]]), True, own, again))
                yield batch(_PACKED, list(zip(*made)))

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """The windows of a range that an earlier one equals, by document."""
    held: list[list[np.ndarray]] = [[], [], []]
    known: list[list[np.ndarray]] = [[], [], []]
    for decided, *raw in zip(*(table.column(n).to_pylist() for n in _PACKED.names[1:])):
        for column, bytes_, kind in zip(known if decided else held, raw, ("<u8", "<i8", "<u4")):
            column.append(numbers(bytes_, kind))
        docs = (known if decided else held)[1]
        docs[-1] = np.cumsum(docs[-1])
    if held[0]:
        own = [np.concatenate(x) for x in held]
        repeats, _ = later(*own)
        for column, values in zip(known, own):
            column.append(values[repeats])
    if not known[0]:
        return _REPEATED.empty_table()
    hashes, docs, starts = (np.concatenate(x) for x in known)
    order = np.lexsort((starts, docs))
    places = (starts[order].astype(np.int64) << 32) | (hashes[order] & LOW).astype(np.int64)
    return pa.table([pa.array(docs[order]), pa.array(places)], schema=_REPEATED)


def _placed(docs: DataFrame) -> DataFrame:
    """The documents with ``doc``, the number that they are ordered by."""
    of_text = F.lit(LEAST_ID) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    return documents(docs).withColumn("doc", F.coalesce("doc_id", of_text))


def repeated_windows(docs: DataFrame, size: int = 20) -> DataFrame:
    """``doc, place``: each window that an earlier one equals.

    ``place`` is the number of words before it, above 32 bits of its hash.
    """
    docs = _placed(docs).select("doc", "text")
    importable(docs.sparkSession)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(0, (total // RANGE_BYTES).bit_length())
    schema = "place long, decided boolean, hashes binary, docs binary, starts binary"
    packed = docs.mapInArrow(_packed(size, bits), schema)
    # about a range a task, whatever the session's numbers, so that sorting them takes little memory
    packed = packed.repartition(min(1 << bits, MOST_TASKS), "place")
    return packed.groupBy("place").applyInArrow(_repeated, "doc long, place long")


_KEPT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()),
     ("removed", pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())])))]
)


def intervals(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and lengths of the maximal runs of marked words."""
    edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2] - edges[::2]


def _kept(size: int) -> Callable:
    def cover(raw: bytes, places: np.ndarray, n: int) -> np.ndarray:
        starts, checks = places >> 32, (places & int(LOW)).astype(np.uint64)
        data = np.frombuffer(raw, np.uint8)
        # rows that share an id have their windows told apart by hash
        own, _, _ = windows(np.array([0, len(data)]), data, size)
        inside = starts < len(own)
        starts, checks = starts[inside], checks[inside]
        starts = starts[own[starts] & LOW == checks]
        change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + size, minlength=n + 1)
        return np.cumsum(change)[:n] > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            offsets, data = text_buffer(part.column(1))
            found = part.column(2)
            edges, places = found.offsets.to_numpy(), found.values.to_numpy()
            for a, b in row_blocks(offsets):
                rows = []
                for i in range(a, b):
                    raw = data[offsets[i] : offsets[i + 1]].tobytes()
                    # bytes are split at 9 to 13 and 32
                    own, gone = raw.split(), ()
                    n = len(own)
                    if edges[i] < edges[i + 1]:
                        covered = cover(raw, places[edges[i] : edges[i + 1]], n)
                        begins, many = intervals(covered)
                        gone = [
                            {"start": s, "words": m} for s, m in zip(begins.tolist(), many.tolist())
                        ]
                        own = [w for w, c in zip(own, covered.tolist()) if not c]
                    rows.append((n, n - len(own), b" ".join(own), gone))
                yield batch(_KEPT, [part.column(0).slice(a, b - a), *zip(*rows)])

    return run


def remove_repeats(docs: DataFrame, size: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, removed``: each text without what stands earlier.

    A word goes if a window of ``size`` words covers it that also starts earlier: in a document of
    smaller id, or further up. ``kept`` has the other words, joined by one space; ``removed`` lists
    the maximal intervals of words.
    """
    repeated = written(repeated_windows(docs, size), "repeated")
    marked = with_filter(_placed(docs), repeated.select("doc"), "doc")
    of_document = repeated.groupBy("doc").agg(F.collect_list("place").alias("found"))
    # texts without any repeat stay where they are
    moved = marked.where("maybe").join(of_document, "doc", "left")
    still = marked.where("NOT maybe").withColumn("found", F.lit(None).cast("array<long>"))
    columns = ["doc_id", "text", "found"]
    schema = (
        "doc_id long, n_words long, n_removed long, kept binary, "
        "removed array<struct<start: long, words: long>>"
    )
    parts = [part.select(*columns).mapInArrow(_kept(size), schema) for part in (moved, still)]
    return parts[0].unionByName(parts[1]).withColumn("kept", F.col("kept").cast("string"))


def digests(made: DataFrame) -> DataFrame:
    """Counts and digests of what was kept."""
    return made.select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )
