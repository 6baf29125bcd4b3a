"""Locations, care sites and providers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalspan import lookups
from vitalspan.functions.clean import address, decimal_comma, number
from vitalspan.operators.conform import conform
from vitalspan.operators.keys import assign_keys
from vitalspan.schemas import table_schema

CITY_COLUMNS = ["OID_", "nome", "geocodigo", "Longitude", "Latitude"]


def city_locations(raw: DataFrame, start: int = 1) -> DataFrame:
    """``location`` rows of municipalities; codes outside the known states are left out.

    The first two digits of the code name the state. Keys follow the code.
    """
    states = lookups.states(raw.sparkSession).select("state_code", "state_name")
    ordered = raw.select(
        "nome",
        "geocodigo",
        decimal_comma(F.col("Latitude")).alias("latitude"),
        decimal_comma(F.col("Longitude")).alias("longitude"),
        F.substring("geocodigo", 1, 2).alias("state_code"),
        "source_row",
    ).join(F.broadcast(states), "state_code")
    keyed = assign_keys(ordered, "location_id", ["geocodigo", "source_row"], start)
    return conform(
        keyed,
        table_schema("location"),
        {
            "location_id": F.col("location_id"),
            "city": F.col("nome"),
            "state": F.col("state_name"),
            "county": F.col("state_code"),
            "location_source_value": F.col("geocodigo"),
            "country_concept_id": F.lit(lookups.COUNTRY_CONCEPT),
            "country_source_value": F.lit(lookups.COUNTRY_NAME),
            "latitude": F.col("latitude"),
            "longitude": F.col("longitude"),
        },
    )


def cities_of_unknown_states(raw: DataFrame) -> DataFrame:
    """Municipalities that ``city_locations`` leaves out, with the line they came from."""
    states = lookups.states(raw.sparkSession).select("state_code")
    code = F.substring("geocodigo", 1, 2)
    unknown = raw.withColumn("state_code", code).join(F.broadcast(states), "state_code", "left_anti")
    return unknown.select("geocodigo", "nome", "Latitude", "Longitude")


def keyed_facilities(raw: DataFrame) -> DataFrame:
    """Facility records with ``facility_rank`` (from 0) in the order of their code.

    Address and care site keys are both this rank plus a start, so the foreign key from care
    site to address needs no join back to the source.
    """
    ordered = raw.select(
        "CO_CNES",
        "NO_RAZAO_SOCIAL",
        "NO_LOGRADOURO",
        "NU_ENDERECO",
        "NO_COMPLEMENTO",
        "NO_BAIRRO",
        "CO_MUNICIPIO_GESTOR",
        "CO_ESTADO_GESTOR",
        "CO_CEP",
        "NU_LATITUDE",
        "NU_LONGITUDE",
        "source_row",
    )
    return assign_keys(ordered, "facility_rank", ["CO_CNES", "source_row"], 0)


def facility_locations(keyed: DataFrame, start: int = 1) -> DataFrame:
    """``location`` rows of facility addresses; they have no county."""
    return conform(
        keyed,
        table_schema("location"),
        {
            "location_id": F.col("facility_rank") + F.lit(start),
            "address_1": address(
                F.col("NO_LOGRADOURO"), F.col("NU_ENDERECO"), F.col("NO_COMPLEMENTO")
            ),
            "address_2": F.col("NO_BAIRRO"),
            "city": F.col("CO_MUNICIPIO_GESTOR"),
            "state": F.col("CO_ESTADO_GESTOR"),
            "zip": F.col("CO_CEP"),
            "location_source_value": F.col("CO_CNES"),
            "country_concept_id": F.lit(lookups.COUNTRY_CONCEPT),
            "country_source_value": F.lit(lookups.COUNTRY_NAME),
            "latitude": number(F.col("NU_LATITUDE"), "float"),
            "longitude": number(F.col("NU_LONGITUDE"), "float"),
        },
    )


def care_sites(
    keyed: DataFrame, start: int = 1, location: int | Column = 1
) -> DataFrame:
    """``care_site`` rows of facilities.

    ``location`` is the key of the first facility's address, or a column with each one's.
    """
    if not isinstance(location, Column):
        location = F.col("facility_rank") + F.lit(location)
    return conform(
        keyed,
        table_schema("care_site"),
        {
            "care_site_id": F.col("facility_rank") + F.lit(start),
            "care_site_name": F.col("NO_RAZAO_SOCIAL"),
            "location_id": location,
            "care_site_source_value": F.col("CO_CNES"),
        },
    )


def seed_care_sites(spark: SparkSession) -> DataFrame:
    """Births outside a facility: at home, elsewhere."""
    return conform(
        lookups.seed_care_sites(spark),
        table_schema("care_site"),
        {
            "care_site_id": F.col("id"),
            "care_site_name": F.col("name"),
            "place_of_service_concept_id": F.col("concept"),
            "care_site_source_value": F.col("code"),
            "place_of_service_source_value": F.col("place"),
        },
    )


def seed_providers(spark: SparkSession) -> DataFrame:
    """Kinds of birth attendants."""
    return conform(
        lookups.providers(spark),
        table_schema("provider"),
        {
            "provider_id": F.col("id"),
            "specialty_concept_id": F.col("concept"),
            "specialty_source_value": F.col("label"),
            "specialty_source_concept_id": F.col("code"),
        },
    )
