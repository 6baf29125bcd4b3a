"""Key filters of fixed size, and the bounds of keys.

A filter has as many bits whatever the number of keys, so it can be broadcast. Rows that it leaves
out have none of the keys for sure; the few others are for a join to decide.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a filter: one megabyte in 131,072 words.
FILTER_BITS = 1 << 23
#: Keys up to which a filter is worth its making: it then rules out three of four others at least.
FILTER_KEYS = FILTER_BITS // 4


class Bounds(NamedTuple):
    """Least and greatest value of a key column, as text that ``comparable`` reads, and its nulls."""

    column: str
    low: str | None
    high: str | None
    nulls: bool


def _place(hashed: Column) -> tuple[Column, Column]:
    """The word of a filter, and the bit in it, that stand for the hash of a key."""
    bit = F.pmod(hashed, F.lit(FILTER_BITS))
    return F.floor(bit / 64).cast("long"), (bit % 64).cast("int")


def may_hold(
    df: DataFrame, keys: DataFrame, columns: Sequence[str], name: str, hashed: str | None = None
) -> DataFrame:
    """``df`` with ``name``: false where ``columns`` are in no row of ``keys`` for sure.

    Nulls are equal to each other. The columns need the same types on both sides; ``keys`` may have
    their ``xxhash64`` instead, as column ``hashed``. With far more keys than bits the filter holds
    everything.
    """
    word, place = _place(F.xxhash64(*columns))
    own_word, own_place = _place(F.col(hashed) if hashed else F.xxhash64(*columns))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), own_place)
    words = keys.groupBy(own_word.alias("filter_word")).agg(F.bit_or(one).alias("filter_bits"))
    joined = df.join(F.broadcast(words), word == F.col("filter_word"), "left")
    found = F.getbit(F.coalesce("filter_bits", F.lit(0).cast("long")), place) == 1
    return joined.withColumn(name, found).drop("filter_word", "filter_bits")


def comparable(kind: T.DataType) -> str:
    """The type whose order the bounds of a column keep as text."""
    if isinstance(kind, (T.TimestampType, T.IntegralType)):
        return "long"
    if isinstance(kind, (T.FractionalType, T.DateType)):
        return kind.simpleString()
    return "string"


def _bound_text(column: Column, kind: T.DataType) -> Column:
    # moments as microseconds, so that no zone matters
    value = F.unix_micros(column) if isinstance(kind, T.TimestampType) else column
    return value.cast("string")


def observe_bounds(
    df: DataFrame, observation: Observation, key: Sequence[str], *more: Column
) -> DataFrame:
    """``df``, whose rows and key bounds, and ``more``, are counted as it is written."""
    metrics = [F.count(F.lit(1)).alias("rows"), *more]
    for i, name in enumerate(key):
        kind = df.schema[name].dataType
        metrics += [
            _bound_text(F.min(name), kind).alias(f"low_{i}"),
            _bound_text(F.max(name), kind).alias(f"high_{i}"),
            F.count_if(F.col(name).isNull()).alias(f"nulls_{i}"),
        ]
    return df.observe(observation, *metrics)


def observed_bounds(observation: Observation, key: Sequence[str]) -> tuple[int, list[Bounds]]:
    """Rows and bounds, once what was observed is written."""
    found = observation.get
    bounds = [
        Bounds(name, found[f"low_{i}"], found[f"high_{i}"], bool(found[f"nulls_{i}"]))
        for i, name in enumerate(key)
    ]
    return found["rows"], bounds


def within(bounds: Sequence[Bounds], schema: T.StructType) -> Column:
    """Rows whose key lies within the bounds; simple enough to reach the file scan."""
    inside = F.lit(True)
    for bound in bounds:
        column, kind = F.col(bound.column), schema[bound.column].dataType
        own = F.lit(False)
        if bound.low is not None:
            low, high = (
                F.timestamp_micros(F.lit(int(text)))
                if isinstance(kind, T.TimestampType)
                else F.lit(text).cast(kind)
                for text in (bound.low, bound.high)
            )
            own = column.between(low, high)
        inside &= own | column.isNull() if bound.nulls else own
    return inside


def overlaps(bound: Bounds, kind: T.DataType) -> Column:
    """Whether stored bounds (``low``, ``high``, ``nulls``) of the same column can share a value."""
    as_type = comparable(kind)
    both = F.lit(False)
    if bound.low is not None:
        both = (F.col("low").try_cast(as_type) <= F.lit(bound.high).cast(as_type)) & (
            F.col("high").try_cast(as_type) >= F.lit(bound.low).cast(as_type)
        )
    return F.coalesce(both, F.lit(False)) | (F.col("nulls") & F.lit(bound.nulls))
