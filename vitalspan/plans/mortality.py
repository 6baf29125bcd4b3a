"""Infant and under-five mortality by state."""

from __future__ import annotations

import math
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalspan import lookups
from vitalspan.functions.clean import age_in_days, in_year
from vitalspan.functions.rates import (
    INFANT_BANDS,
    UNDER_FIVE_BANDS,
    band_label,
    band_ordinal,
    rate_per_thousand,
)

if TYPE_CHECKING:
    from vitalspan.store import TableStore

INFANT_DAYS = 365
UNDER_FIVE_DAYS = 1825


def _sums_by_state(events: DataFrame, location: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """Counts per state. Events are counted per location first, so the join to the locations and
    the second aggregate see one row per location, however many events a city has."""
    per_location = events.groupBy("location_id").agg(
        *[value.alias(name) for name, value in counts.items()]
    )
    located = per_location.join(location.select("location_id", "county"), "location_id")
    return located.groupBy(F.col("county").alias("state")).agg(
        *[F.sum(name).alias(name) for name in counts]
    )


def births_by_state(births: DataFrame, location: DataFrame, year: int) -> DataFrame:
    """Live births of a year per state code."""
    of_year = births.where(in_year(F.col("birth_timestamp"), year))
    return _sums_by_state(of_year, location, {"live_births": F.count(F.lit(1))})


def deaths_by_state(deaths: DataFrame, location: DataFrame, year: int) -> DataFrame:
    """Deaths of a year per state code: in the first year and in the first five years of life.

    A death before the birth is a data error; it is counted on its own and in neither age group.
    """
    of_year = deaths.where(in_year(F.col("death_timestamp"), year)).withColumn(
        "age", age_in_days(F.col("death_timestamp"), F.col("birth_timestamp"))
    )
    age = F.col("age")
    return _sums_by_state(
        of_year,
        location,
        {
            "deaths_0_1": F.count_if(age.between(0, INFANT_DAYS)),
            "deaths_0_5": F.count_if(age.between(0, UNDER_FIVE_DAYS)),
            "deaths_before_birth": F.count_if(age < 0),
        },
    )


def _state_labels(frame: DataFrame) -> DataFrame:
    """``iso_estado`` for the state code, from the 27 fixed states."""
    labels = lookups.states(frame.sparkSession).select(
        F.col("state_code").alias("state"),
        F.concat_ws("-", F.lit(lookups.ISO_COUNTRY), "state_abbreviation").alias("iso"),
    )
    return frame.join(F.broadcast(labels), "state", "left").withColumn(
        "iso_estado", F.coalesce("iso", F.lit(lookups.UNKNOWN_STATE))
    )


def mortality_rates(
    births: DataFrame, deaths: DataFrame, location: DataFrame, year: int
) -> DataFrame:
    """Rates per thousand live births with their bands, one row per state with births.

    ``births`` needs location_id and birth_timestamp, ``deaths`` also death_timestamp.
    """
    counts = births_by_state(births, location, year).join(
        deaths_by_state(deaths, location, year), "state", "left"
    )
    infant, under_five = F.col("taxa_mortalidade_0_1_ano"), F.col("taxa_mortalidade_0_5_anos")
    rates = _state_labels(counts).select(
        "iso_estado",
        rate_per_thousand(F.col("deaths_0_1"), F.col("live_births")).alias(
            "taxa_mortalidade_0_1_ano"
        ),
        rate_per_thousand(F.col("deaths_0_5"), F.col("live_births")).alias(
            "taxa_mortalidade_0_5_anos"
        ),
    )
    return rates.select(
        "*",
        band_label(infant, INFANT_BANDS).alias("categoria_mortalidade_0_1_ano"),
        band_label(under_five, UNDER_FIVE_BANDS).alias("categoria_mortalidade_0_5_anos"),
        band_ordinal(infant, INFANT_BANDS).alias("categoria_mortalidade_0_1_ano_num"),
        band_ordinal(under_five, UNDER_FIVE_BANDS).alias("categoria_mortalidade_0_5_anos_num"),
    ).orderBy("iso_estado")


def births_of_model(person: DataFrame, birth_extension: DataFrame) -> DataFrame:
    """Persons that come from a birth record.

    Both sides grow with the records. The join is a sorted one, because Spark takes one column of a
    wide stored table for so small that it would broadcast millions of persons.
    """
    return person.select("person_id", "location_id", "birth_timestamp").join(
        birth_extension.select("person_id").hint("merge"), "person_id", "left_semi"
    )


def deaths_of_model(person: DataFrame, death: DataFrame) -> DataFrame:
    """Persons with their death. A birth and a death record are two persons; they are not linked."""
    return person.select("person_id", "location_id", "birth_timestamp").join(
        death.select("person_id", "death_timestamp").hint("merge"), "person_id"
    )


def mortality_rates_of_model(
    person: DataFrame, birth_extension: DataFrame, death: DataFrame, location: DataFrame, year: int
) -> DataFrame:
    """The report over the tables of the model."""
    return mortality_rates(
        births_of_model(person, birth_extension), deaths_of_model(person, death), location, year
    )


def mortality_rates_of_store(store: TableStore, year: int) -> DataFrame:
    """The report over the stored tables.

    Where they are clustered, births and their extension are read from the year's partition, deaths
    from theirs, and of the other persons only those born recently enough to count, as nobody over
    five years of age does. The joins by person need no exchange.
    """
    oldest = year - math.ceil(UNDER_FIVE_DAYS / 365)
    born = births_of_model(
        store.of_years("person", year, year), store.of_years("datasus_person", year, year)
    )
    died = deaths_of_model(
        store.of_years("person", oldest, year), store.of_years("death", year, year)
    )
    return mortality_rates(born, died, store.read("location"), year)
