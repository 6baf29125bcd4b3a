"""What the operators share: scratch tables, Arrow helpers, input preparation."""

from __future__ import annotations

import contextlib
import ctypes
import io
import os
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalspan.session import delete_at_exit, scratch_path

#: Text handled at once, which bounds the arrays that are several times as wide as the text.
BLOCK_BYTES = 1 << 20

#: Bytes of rows that go to a Python worker at once, unless the session has its own setting. Spark and
#: the worker each hold a batch several times, and Spark keeps the memory of its largest ones.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))

#: Where this package lies.
PACKAGE = Path(__file__).resolve().parent.parent

_shipped: set[str] = set()


def importable(spark: SparkSession) -> None:
    """Ships this package to the Python workers, once a session, which get small batches from then on.

    Executors on other machines have no copy of the driver's folder. The archive lies in the shared
    scratch folder, from where Spark hands it to every worker.
    """
    if spark.conf.get(BATCH[0], None) is None:
        spark.conf.set(*BATCH)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(PACKAGE.rglob("*.py")):
            archive.write(file, file.relative_to(PACKAGE.parent))
    name = scratch_path(spark, PACKAGE.name) + ".zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    stream = files.create(path)
    stream.write(content.getvalue())
    stream.close()
    delete_at_exit(spark, name)
    context.addPyFile(files.makeQualified(path).toString())
    _shipped.add(context.applicationId)


def released() -> None:
    """Gives what a task has freed back to the system, as its worker outlives it and keeps it else."""
    pa.default_memory_pool().release_unused()
    # only the GNU C library has this
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder, read again.

    That cuts the lineage, survives lost executors, and gives Spark the size of the table. The
    folder goes when the session's file system is closed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a scratch table that nothing reads any more."""
    spark = df.sparkSession
    for name in {os.path.dirname(f) for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Bits of a key filter, however many keys there are.
FILTER_BITS = 1 << 23


def with_filter(df: DataFrame, keys: DataFrame, *columns: str, name: str = "maybe") -> DataFrame:
    """``df`` with a column that is false only where ``columns`` are in no row of ``keys``.

    The keys' hashes set bits of a table of fixed size (131,072 words at most), which is broadcast.
    So most rows that a join would only drop, or leave alone, need not be moved; a join of the
    others decides. With far more keys than bits the filter lets all rows pass.
    """
    bit = F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))
    word, place = F.floor(bit / 64), (bit % 64).cast("int")
    one = F.lit(1).cast("long")
    words = keys.select(word.alias("w_"), F.call_function("shiftleft", one, place).alias("b_"))
    words = words.groupBy("w_").agg(F.bit_or("b_").alias("b_"))
    held = df.join(F.broadcast(words), word == F.col("w_"), "left")
    found = F.coalesce(F.getbit("b_", place), F.lit(0).cast("byte")) == 1
    return held.withColumn(name, found).drop("w_", "b_")


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """The columns an operator needs, whatever else the table has."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    first = int(offsets[0])
    return offsets.astype(np.int64) - first, data[first : int(offsets[-1])]


def row_blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Cuts rows into runs of about ``most`` bytes, a longer row being alone."""
    begin, n = 0, len(offsets) - 1
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
        end = min(max(end, begin + 1), n)
        yield begin, end
        begin = end


def batch(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )
