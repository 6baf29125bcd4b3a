"""File scans with declared schemas and row lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def with_lineage(scan: DataFrame) -> DataFrame:
    """Adds ``source_file`` and ``source_row``, which together identify a record for good."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.row_index").alias("source_row"),
    )


def read_parquet(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Parquet scan. With a declared schema no footers are merged and absent columns are null."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def read_folder(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.parquet",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """All matching Parquet files below a folder in one scan, whatever columns each year has.

    Without a declared schema the footers are merged in a distributed job; a declared schema
    saves that pass.
    """
    reader = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .option("mergeSchema", str(schema is None).lower())
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(folder)


def read_delimited(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, sep: str = ";"
) -> DataFrame:
    """Delimited text with a header, every column a string, and ``source_row``.

    Without ``columns`` the header names them; reading it takes one line.
    Types are not inferred: inference reads the data an extra time and drops the leading zeros of
    codes. ``source_row`` grows along the file; taken directly on the scan, it is the same
    whenever a task is repeated.
    """
    if columns is None:
        columns = spark.read.csv(path, sep=sep, header=True).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    scan = spark.read.schema(schema).csv(path, sep=sep, header=True, enforceSchema=False)
    return scan.withColumn("source_row", F.monotonically_increasing_id())


def read_typed_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    sep: str = "\t",
    quote: str = '"',
) -> DataFrame:
    """Delimited text with a declared schema; lines that do not fit it land in ``CORRUPT``.

    Column pruning is off for these reads, because a line would otherwise only count as broken in
    queries that use its broken field.
    """
    fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
    fields.append(T.StructField(CORRUPT, T.StringType()))
    reader = spark.read.schema(T.StructType(fields)).option("columnPruning", "false")
    return reader.csv(
        path if isinstance(path, str) else list(path),
        sep=sep,
        quote=quote,
        header=True,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
    )


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files, one row per file."""
    return spark.read.text(path, wholetext=True)
