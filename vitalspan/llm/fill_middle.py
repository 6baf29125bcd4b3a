"""Fill-in-the-middle order of texts by block rotations in place, and back.

A text is cut twice, into prefix, middle and suffix. Both forms are made in one byte array: the
sentinels are inserted at the cuts, then two neighbouring segments change places by three
reversals, those of each segment and that of both together. Restoring finds the sentinels, turns
the same rotation round and takes them out.

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle

The cuts, and which form a text gets, follow from digits of the SHA-256 of its id, so that every
run gives the same. A text that holds a sentinel stays plain, as do empty ones and a share of all.

A null text is empty, a null id is written as no digits. Rows that repeat an id are cut by the same
numbers, repeated rows give repeated results. Texts are handled one at a time, however long. Other
columns are not read, so their names can't clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalspan.llm.common import batch, documents, importable, row_blocks, text_buffer

#: What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

#: Output text given on at once.
OUT_BYTES = 4 << 20


def rotate(block: np.ndarray, begin: int, middle: int, end: int) -> None:
    """Exchanges ``block[begin:middle]`` and ``block[middle:end]`` in place."""
    for a, b in ((begin, middle), (middle, end), (begin, end)):
        half = (b - a) // 2
        left, right = block[a : a + half], block[b - half : b]
        held = left.copy()
        left[:] = right[::-1]
        right[:] = held[::-1]


def numbers(doc_id: int | None) -> tuple[int, int, int, int]:
    """The four numbers that decide over a document: two cuts, whether, and in which form."""
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else b"%d" % doc_id)).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def scan_cuts(raw: np.ndarray, *cuts: int) -> list[int]:
    """The byte at which each code point, given in ascending order, begins."""
    heads = np.flatnonzero((raw & 0xC0) != 0x80)
    return [int(heads[c]) if c < len(heads) else len(raw) for c in cuts]


def forward(raw: bytes, first: int, second: int, form: str) -> bytearray:
    """The text in its form, cut at the bytes ``first`` and ``second``."""
    whole = bytearray(raw)
    whole[second:second] = SUFFIX
    whole[first:first] = MIDDLE
    whole[0:0] = PREFIX
    begin = 0 if form == "spm" else first + len(PREFIX)
    middle = second + len(PREFIX) + len(MIDDLE)
    rotate(np.frombuffer(whole, np.uint8), begin, middle, len(whole))
    return whole


def backward(output: bytes, form: str) -> bytearray:
    """The text that ``forward`` was given. Sentinels can't occur in texts that have a form."""
    whole = bytearray(output)
    if form == "plain":
        return whole
    begin = 0 if form == "spm" else whole.index(SUFFIX)
    split = whole.index(PREFIX if form == "spm" else MIDDLE, begin)
    rotate(np.frombuffer(whole, np.uint8), begin, split, len(whole))
    # now prefix, middle and suffix stand in order, each behind its sentinel
    at = whole.index(MIDDLE)
    last = whole.index(SUFFIX, at)
    del whole[last : last + len(SUFFIX)]
    del whole[at : at + len(MIDDLE)]
    del whole[: len(PREFIX)]
    return whole


_FORWARD = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
     ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())]
)


def _texts(column: pa.Array) -> Iterator[tuple[int, bytes]]:
    """Rows and their bytes."""
    offsets, data = text_buffer(column)
    for i in range(len(offsets) - 1):
        yield i, data[offsets[i] : offsets[i + 1]].tobytes()


def _transform(rate: int, spm_rate: int) -> Callable:
    def of(doc_id: int | None, raw: bytes) -> tuple:
        view = np.frombuffer(raw, np.uint8)
        n = int(np.count_nonzero((view & 0xC0) != 0x80))
        h1, h2, h3, h4 = numbers(doc_id)
        if not n or h3 % 100 >= rate or any(s in raw for s in (PREFIX, SUFFIX, MIDDLE)):
            return doc_id, n, "plain", None, None, raw
        first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
        form = "spm" if h4 % 100 < spm_rate else "psm"
        made = bytes(forward(raw, *scan_cuts(view, first, second), form))
        return doc_id, n, form, first, second - first, made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            keys, rows, size = part.column(0), [], 0
            for i, raw in _texts(part.column(1)):
                rows.append(of(keys[i].as_py(), raw))
                size += len(rows[-1][-1])
                if size >= OUT_BYTES:
                    yield batch(_FORWARD, list(zip(*rows)))
                    rows, size = [], 0
            if rows:
                yield batch(_FORWARD, list(zip(*rows)))

    return run


def transform(docs: DataFrame, rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """Every text in the order its id decides: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts code points. ``rate`` of 100 texts change, ``spm_rate`` of 100 of these get the
    suffix first. Lengths are null where the form is plain.
    """
    importable(docs.sparkSession)
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
    made = documents(docs).mapInArrow(_transform(rate, spm_rate), schema)
    return made.withColumn("output", F.col("output").cast("string"))


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        forms, column = part.column("form").to_pylist(), part.column("output")
        offsets, _ = text_buffer(column)
        for a, b in row_blocks(offsets, OUT_BYTES):
            own = column.slice(a, b - a)
            texts = [bytes(backward(raw, forms[a + i])) for i, raw in _texts(own)]
            yield pa.RecordBatch.from_arrays(
                [*part.slice(a, b - a).columns, pa.array(texts, pa.binary())],
                names=[*part.schema.names, "restored"],
            )


def restore(made: DataFrame) -> DataFrame:
    """``made`` with the text behind each ``output``, found from it and ``form`` alone."""
    importable(made.sparkSession)
    kept = made.drop("restored")
    schema = T.StructType([*kept.schema.fields, T.StructField("restored", T.BinaryType())])
    return kept.mapInArrow(_restore, schema).withColumn("restored", F.col("restored").cast("string"))


def digests(made: DataFrame) -> DataFrame:
    """Digests of the outputs and of what they are restored to."""
    return restore(made).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )
