"""Joins of records to dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A lookup of up to this many rows is broadcast: a key and a few short values, well below 100 MB.
MAX_BROADCAST_ROWS = 500_000


def unique_lookup(dimension: DataFrame, key: Column, columns: Mapping[str, str]) -> DataFrame:
    """``lookup_key`` and the given ``{name: dimension column}``, one row per key.

    The row with the lowest values wins, in the order of the columns. A duplicated dimension row
    would otherwise multiply every record that refers to it. The minimum combines map-side, so a
    key with many copies costs no more than others.
    """
    values = F.struct(*[F.col(source).alias(name) for name, source in columns.items()])
    return (
        dimension.select(key.alias("lookup_key"), values.alias("values"))
        .where(F.col("lookup_key").isNotNull())
        .groupBy("lookup_key")
        .agg(F.min("values").alias("values"))
        .select("lookup_key", "values.*")
    )


def join_lookup(records: DataFrame, key: Column, lookup: DataFrame) -> DataFrame:
    """Left join of records to a lookup; unmatched records keep nulls.

    The lookup is counted first. Up to the limit, it is broadcast, and the records stay
    where they are. That is not left to the optimizer, which judges a filtered and grouped table
    by the size of the whole, and would exchange the records before it knew better. Above it, both
    sides are sorted and adaptive execution splits skewed keys of the records.
    """
    if lookup.count() <= MAX_BROADCAST_ROWS:
        lookup = F.broadcast(lookup)
    return records.join(lookup, key == F.col("lookup_key"), "left").drop("lookup_key")


def attach(
    records: DataFrame,
    key: Column,
    dimension: DataFrame,
    dimension_key: Column,
    columns: Mapping[str, str],
) -> DataFrame:
    """Adds ``{name: dimension column}`` to the records by key."""
    return join_lookup(records, key, unique_lookup(dimension, dimension_key, columns))


def city_rows(location: DataFrame) -> DataFrame:
    """The municipalities of a location table; facility addresses have no county."""
    return location.where(F.col("county").isNotNull())


def facility_rows(location: DataFrame) -> DataFrame:
    """The facility addresses of a location table."""
    return location.where(F.col("county").isNull())


def attach_city(records: DataFrame, location: DataFrame, code: str = "CODMUNRES") -> DataFrame:
    """``location_id_city`` by the first six digits of the seven-digit municipality code."""
    six_digits = F.substring("location_source_value", 1, 6)
    columns = {"location_id_city": "location_id"}
    return attach(records, F.col(code), city_rows(location), six_digits, columns)


def attach_care_site(
    records: DataFrame, care_site: DataFrame, code: str = "CODESTAB"
) -> DataFrame:
    """``care_site_id`` by facility code."""
    columns = {"care_site_id": "care_site_id"}
    return attach(records, F.col(code), care_site, F.col("care_site_source_value"), columns)
