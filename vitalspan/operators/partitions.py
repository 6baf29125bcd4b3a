"""The latest partition of a partitioned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def latest_partition(
    df: DataFrame, columns: Sequence[str], compared: Sequence[str] | None = None
) -> DataFrame:
    """Rows of the greatest partition, compared column by column in the columns' own types.

    The greatest values come from a scalar subquery over the partition columns alone, which
    reads no data pages; its result prunes the partitions of the outer scan. Partitions with a
    null are not looked at. ``compared`` are the columns that rows are held against, all unless
    given.
    """
    spark = df.sparkSession
    known = " AND ".join(f"`{c}` IS NOT NULL" for c in columns)
    names = ", ".join(f"`{c}`" for c in columns)
    greatest = f"SELECT max(struct({names})) AS top FROM {{df}} WHERE {known}"
    condition = " AND ".join(
        f"`{c}` = (SELECT top.`{c}` FROM ({greatest}))" for c in compared or columns
    )
    return spark.sql(f"SELECT * FROM {{df}} WHERE {condition}", df=df)


def latest_table_partition(
    spark: SparkSession, table: str, projection: Sequence[str] | None = None
) -> DataFrame:
    """Rows of the latest partition of a catalog table.

    A table without partitions, or a projection without its partition columns, is not filtered.
    """
    df = spark.read.table(table)
    columns = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    selected = list(projection or df.columns)
    kept = [c for c in columns if c in selected]
    return (latest_partition(df, columns, kept) if kept else df).select(*selected)
