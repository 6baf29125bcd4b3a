"""Row contracts: which rows may enter a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalspan.schemas import required_columns


def _complete(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in columns], F.lit(True))


def split_complete(
    df: DataFrame, columns: list[str], seen: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows with all of ``columns`` present, and the others with the name of what they lack.

    With ``seen``, any write of the first also counts both kinds, and collects the names of the
    files (``source_file``) that have any of the second.
    """
    reason = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    if seen is not None:
        df = df.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~_complete(columns)).alias("rejected"),
            F.collect_set(F.when(~_complete(columns), F.col("source_file"))).alias("files"),
        )
    accepted = df.where(_complete(columns))
    rejected = df.where(~_complete(columns)).withColumn("missing_columns", reason)
    return accepted, rejected


def enforce_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The same rows; a null in a required column fails the job that writes them."""

    def column(name: str) -> Column:
        if name not in required:
            return F.col(name)
        failure = F.raise_error(F.lit(f"required column {name} is null"))
        return F.coalesce(F.col(name), failure.cast(df.schema[name].dataType)).alias(name)

    required = set(required_columns(schema))
    return df.select(*[column(name) for name in df.columns])


def violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Null counts of the required columns, one row per column, from a single aggregate."""
    columns = [name for name in required_columns(schema) if name in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in columns],
    )
    cells = F.array(
        *[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("null_rows")) for n in columns]
    )
    return counts.select("rows_checked", F.inline(cells))
