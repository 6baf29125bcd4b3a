"""How the event tables of the model are laid out when they are clustered.

A clustered table is partitioned by the year of its event, so that a report over a year opens that
year only, and bucketed and sorted by person, so that person, extension and death are joined where
they lie. The year is a column of the stored table, not of the model.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

#: How tables are written. Keys that count up and repeat by record, most of the bytes of a fact
#: table, are stored as their differences by the second version of the format.
WRITING = {"compression": "zstd", "parquet.writer.version": "v2"}
#: How moments are stored, unless the session says how. Spark takes it from the session only. With
#: the twelve bytes of the older form, comparing bytes in the writer's dictionary was the largest
#: entry of a profile of ``load_deaths``.
MOMENTS = ("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


class Layout(NamedTuple):
    """The partition column, the SQL that gives it, and the column of the buckets."""

    partition: str
    value: str
    bucket: str = "person_id"


LAYOUTS = {
    "person": Layout("birth_year", "year(birth_timestamp)"),
    "death": Layout("death_year", "year(coalesce(death_timestamp, death_date))"),
    "datasus_person": Layout("source_year", "year(datasus_person_source_date)"),
    "datasus_death": Layout("source_year", "year(datasus_person_source_date)"),
}


def clustered_ddl(name: str, schema: T.StructType, layout: Layout, buckets: int) -> str:
    """The statement that creates a clustered table."""
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
    columns.append(f"`{layout.partition}` int")
    options = ", ".join(f"'{key}' '{value}'" for key, value in WRITING.items())
    return (
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet OPTIONS ({options}) "
        f"PARTITIONED BY ({layout.partition}) "
        f"CLUSTERED BY ({layout.bucket}) SORTED BY ({layout.bucket}) INTO {int(buckets)} BUCKETS"
    )
