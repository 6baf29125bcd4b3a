"""Birth records to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vitalspan import lookups
from vitalspan.functions import clean, codes
from vitalspan.operators.conform import conform, mapped_values
from vitalspan.operators.contract import split_complete
from vitalspan.operators.lookup import attach_care_site, attach_city
from vitalspan.plans import facts, mappings
from vitalspan.schemas import table_schema


def clean_births(raw: DataFrame) -> DataFrame:
    """Records with a date, a valid or zero clock time, and ``event_ts`` where both parse."""
    dated = raw.where(clean.has_event_date(F.col("DTNASC"))).withColumn(
        "HORANASC", clean.clock_or_midnight(F.col("HORANASC"))
    )
    return clean.with_parsed(
        dated, "event_ts", clean.event_timestamp(F.col("DTNASC"), F.col("HORANASC"))
    )


def accepted_births(
    raw: DataFrame, seen: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Cleaned records that can enter the tables, and those set aside; ``seen`` counts both."""
    return split_complete(clean_births(raw), ["event_ts"], seen)


def person(keyed: DataFrame, location: DataFrame, care_site: DataFrame) -> DataFrame:
    """``person`` rows of keyed birth records."""
    records = attach_care_site(attach_city(keyed, location), care_site)
    ts = F.col("event_ts")
    return conform(
        records,
        table_schema("person"),
        {
            "person_id": F.col("person_id"),
            "gender_concept_id": codes.gender_concept(F.col("SEXO")),
            "year_of_birth": clean.date_part_or_zero(F.year(ts)),
            "month_of_birth": clean.date_part_or_zero(F.month(ts)),
            "day_of_birth": clean.date_part_or_zero(F.dayofmonth(ts)),
            "birth_timestamp": ts,
            "race_concept_id": codes.race_concept(F.col("RACACOR")),
            "ethnicity_concept_id": F.lit(lookups.ETHNICITY_CONCEPT),
            "location_id": F.col("location_id_city"),
            "care_site_id": F.col("care_site_id"),
            "gender_source_value": F.col("SEXO"),
            "race_source_value": codes.label_or_null_label(F.col("RACACOR")),
        },
    )


def observation_period(keyed: DataFrame, person_start: int = 1, start: int = 1) -> DataFrame:
    """One period per birth, from and to the moment of birth."""
    return conform(
        keyed,
        table_schema("observation_period"),
        {
            "observation_period_id": F.col("person_id") - F.lit(person_start) + F.lit(start),
            "person_id": F.col("person_id"),
            "observation_period_start_date": F.col("event_ts"),
            "observation_period_end_date": F.col("event_ts"),
            "period_type_concept_id": F.lit(lookups.BIRTH_PERIOD_CONCEPT),
        },
    )


def extension(keyed: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """``datasus_person`` rows: what the record says about mother, father and informant."""
    schema = table_schema("datasus_person")
    values = mapped_values(
        keyed, schema, mappings.BIRTH_EXTENSION, mappings.BIRTH_EXTENSION_OPTIONAL
    )
    values.update(
        {
            "person_id": F.col("person_id"),
            "system_source_id": F.lit(lookups.BIRTH_SYSTEM),
            "datasus_person_source_date": F.col("event_ts").cast("date"),
            "ingestion_timestamp": F.current_timestamp() if ingested_at is None else ingested_at,
            "source_file": F.col("source_file"),
        }
    )
    return conform(keyed, schema, values)


def condition_occurrence(keyed: DataFrame, person_start: int = 1, start: int = 1) -> DataFrame:
    return facts.conditions(
        keyed, mappings.BIRTH_CONDITIONS, lookups.BIRTH_TYPE_CONCEPT, person_start, start
    )


def procedure_occurrence(keyed: DataFrame, person_start: int = 1, start: int = 1) -> DataFrame:
    return facts.procedures(
        keyed, mappings.BIRTH_PROCEDURES, lookups.BIRTH_TYPE_CONCEPT, person_start, start
    )


def measurement(keyed: DataFrame, person_start: int = 1, start: int = 1) -> DataFrame:
    return facts.measurements(
        keyed, mappings.BIRTH_MEASUREMENTS, lookups.BIRTH_TYPE_CONCEPT, person_start, start
    )


def observation(keyed: DataFrame, person_start: int = 1, start: int = 1) -> DataFrame:
    return facts.observations(
        keyed, mappings.BIRTH_OBSERVATIONS, lookups.BIRTH_TYPE_CONCEPT, person_start, start
    )
