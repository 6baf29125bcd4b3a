"""Surrogate keys that are dense and do not change when the plan runs again.

None of the ways below numbers rows in a single task or through a global window over the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalspan.session import delete_at_exit, scratch_path

# Offsets of up to this many files, some 200 bytes each, are broadcast.
MAX_BROADCAST_FILES = 10_000
# rows of a file that one key of the exchange stands for, where there are more files
BLOCK_ROWS = 1 << 20


def next_key(table: DataFrame, id_col: str, floor: int = 1) -> int:
    """The first free key of a table at or above ``floor``; ``floor`` itself for an empty one."""
    taken = table.where(F.col(id_col) >= floor).agg(F.max(id_col))
    return taken.select(F.coalesce(F.col(f"max({id_col})") + 1, F.lit(floor))).first()[0]


def _running_offsets(sizes: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows of each file and before it. One row per file, not per record, so one task is enough."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        "key_file", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before")
    )


def file_offsets(scan: DataFrame) -> DataFrame:
    """``key_file``, ``rows`` and ``rows_before`` of the files of a scan with lineage, in path order.

    The counts come from file footers.
    """
    sizes = scan.groupBy(F.col("source_file").alias("key_file")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return _running_offsets(sizes, [F.col("key_file")])


def assign_keys(
    df: DataFrame, id_col: str, order_by: Sequence[str | Column], start: int = 1
) -> DataFrame:
    """Adds ``id_col`` = ``start`` + rank of the row under ``order_by``.

    The sorted rows are written once to the shared scratch folder; key = rows in earlier files +
    position in the file. Both are facts about written files, so recomputing any later stage, on
    any executor, gives the same keys. The offsets are read from the file footers.

    ``order_by`` should be a total order, with lineage columns last if the natural key may
    repeat: rows are range-partitioned on all of it, so a key that many rows share is still
    spread over tasks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "keys")
    df.orderBy(*order_by).write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    placed = stored.select(
        "*",
        F.col("_metadata.file_name").alias("key_file"),
        F.col("_metadata.row_index").alias("key_row"),
    )
    sizes = placed.groupBy("key_file").agg(F.count(F.lit(1)).alias("rows"))
    part = F.regexp_extract("key_file", r"part-(\d+)", 1).cast("int")
    offsets = _running_offsets(sizes, [part, F.col("key_file")]).drop("rows")
    # one row per file that the sort wrote; as a stored table its size is known to the planner
    table = scratch_path(spark, "offsets")
    offsets.write.parquet(table)
    delete_at_exit(spark, path, table)
    keyed = placed.join(spark.read.schema(offsets.schema).parquet(table), "key_file")
    return keyed.select(
        (F.lit(start) + F.col("rows_before") + F.col("key_row")).cast("long").alias(id_col),
        *df.columns,
    )


def assign_keys_by_position(
    records: DataFrame,
    scan: DataFrame,
    id_col: str,
    start: int = 1,
    offsets: DataFrame | None = None,
) -> DataFrame:
    """Adds ``id_col`` = ``start`` + position of the record in the scanned files, in path order.

    ``scan`` is the frame as read, ``records`` whatever was made of it, with the lineage columns
    ``source_file`` and ``source_row``. Records are not sorted. Keys are dense over the files; a
    record that was filtered out leaves its number unused. ``offsets`` are those of
    ``file_offsets``, if they are at hand; the caller may mark them for broadcast where it bounds
    the number of files.

    Offsets taken here are broadcast, as Spark would exchange the records by file, a whole file to
    one task, before it knew how few they are. Those of very many files are joined by blocks of
    rows instead.
    """
    same = F.col("source_file") == F.col("key_file")
    if offsets is None:
        offsets = file_offsets(scan)
        if len(scan.inputFiles()) <= MAX_BROADCAST_FILES:
            offsets = F.broadcast(offsets)
        else:
            blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"rows div {BLOCK_ROWS}"))
            offsets = offsets.select("key_file", "rows_before", F.explode(blocks).alias("key_block"))
            same &= F.expr(f"source_row div {BLOCK_ROWS}") == F.col("key_block")
    keyed = records.join(offsets, same)
    return keyed.select(
        (F.lit(start) + F.col("rows_before") + F.col("source_row")).cast("long").alias(id_col),
        *records.columns,
    )


def child_key(
    parent: Column, parent_start: int, width: int, position: Column, start: int
) -> Column:
    """Key of the ``position``-th of ``width`` children of a record with a dense key.

    Plain arithmetic: dense when the parent's key is, and free of any exchange.
    """
    return F.lit(start) + (parent - F.lit(parent_start)) * F.lit(width) + position
