"""Projection of a source frame to a target schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalspan.functions.clean import number, source_date


def conform(
    df: DataFrame, schema: T.StructType, values: Mapping[str, Column | str]
) -> DataFrame:
    """One select that gives ``df`` exactly the columns and types of ``schema``.

    Values are columns or SQL expressions, so a mapping may come from data, and are bound by
    name. A target column without a value becomes a typed null, a value without a target column
    is an error.
    """
    unknown = set(values) - set(schema.names)
    if unknown:
        raise ValueError(f"not in the target schema: {', '.join(sorted(unknown))}")

    def column(name: str) -> Column:
        value = values.get(name, F.lit(None))
        return F.expr(value) if isinstance(value, str) else value

    return df.select(
        *[column(field.name).cast(field.dataType).alias(field.name) for field in schema.fields]
    )


def source_value(column: str, target: T.DataType) -> Column:
    """A source string converted the way its target type asks for."""
    if isinstance(target, T.NumericType):
        return number(F.col(column), target.simpleString())
    if isinstance(target, (T.DateType, T.TimestampType)):
        return source_date(F.col(column))
    return F.col(column)


def mapped_values(
    df: DataFrame, schema: T.StructType, mapping: Mapping[str, str], optional: frozenset[str]
) -> dict[str, Column]:
    """Values of ``{target: source column}``.

    A source column listed as optional may be absent, in which case the target is left to the
    typed null of ``conform``; any other absent column is an error.
    """
    missing = set(mapping.values()) - set(df.columns) - optional
    if missing:
        raise ValueError(f"source columns missing: {', '.join(sorted(missing))}")
    return {
        target: source_value(source, schema[target].dataType)
        for target, source in mapping.items()
        if source in df.columns
    }
