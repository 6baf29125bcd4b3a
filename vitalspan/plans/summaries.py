"""Summaries and previews of a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalspan.functions.grains import time_grain


def time_summary(df: DataFrame, ts: str, grain: str | None, *aggregates: Column) -> DataFrame:
    """Aggregates per period of a time grain, as column ``bucket``."""
    return df.groupBy(time_grain(F.col(ts), grain).alias("bucket")).agg(*aggregates)


def preview(df: DataFrame, order_by: Sequence[str | Column], rows: int = 100) -> DataFrame:
    """The first rows under an order: a top-k per task and one merge, not a full sort."""
    return df.orderBy(*order_by).limit(rows)


def browse(df: DataFrame, column: str | None = None, rows: int = 1000) -> DataFrame:
    """Any rows of a table, or of one of its columns."""
    return (df if column is None else df.select(column)).limit(rows)


def _typed_literal(df: DataFrame, column: str, moment: dt.datetime) -> Column:
    # as text, because the zone of the driver's process must not matter
    return F.lit(moment.isoformat(sep=" ")).cast(df.schema[column].dataType)


def time_filter(df: DataFrame, column: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Rows from ``start`` up to ``end``, with literals of the column's own type.

    The column itself is not converted, so the filter reaches the scan.
    """
    value = F.col(column)
    return df.where(
        (value >= _typed_literal(df, column, start)) & (value < _typed_literal(df, column, end))
    )
