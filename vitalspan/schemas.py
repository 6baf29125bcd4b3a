"""Registry of the 42 tables of the clinical data model (version 5.4 plus three extensions)."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}

# fixed values: names of the climate variables and pollutants
CLIMATE_VARIABLES = {
    # target name -> source prefix
    "temperature_min": "TMIN",
    "temperature_max": "TMAX",
    "precipitation": "PR",
    "relative_humidity": "RH",
    "solar_radiaton": "Rs",
    "wind_speed": "u2",
    "evapotranspiration": "ETo",
}
CLIMATE_STATISTICS = ("mean", "min", "max", "stdev", "sum")
POLLUTANTS = {
    # target name -> source name
    "ethane_c2h6": "c2h6",
    "acetone_ch3coch3": "ch3coch3",
    "methane_ch4": "ch4",
    "carbon_monoxide_co": "co",
    "carbon_dioxide_co2s": "co2s",
    "hydrogen_chloride_hcl": "hcl",
    "max_to_min_concentration_rate_mmrpm10": "mmrpm10",
    "max_to_min_concentration_rate_mmrpm2p5": "mmrpm2p5",
    "nitrogen_dioxide_no2": "no2",
    "maximum_tropospheric_ozone_sfo3max": "sfo3max",
    "sulfur_dioxide_so2": "so2",
}

# fixed values: the columns of the model's tables
_TABLES = {
    "person": """
        person_id BIGINT NOT NULL, gender_concept_id BIGINT NOT NULL, year_of_birth INT NOT
        NULL, month_of_birth INT, day_of_birth INT, birth_timestamp TIMESTAMP, race_concept_id
        BIGINT NOT NULL, ethnicity_concept_id BIGINT NOT NULL, location_id BIGINT, provider_id
        BIGINT, care_site_id BIGINT, person_source_value STRING, gender_source_value STRING,
        gender_source_concept_id BIGINT, race_source_value STRING, race_source_concept_id
        BIGINT, ethnicity_source_value STRING, ethnicity_source_concept_id BIGINT
    """,
    "observation_period": """
        observation_period_id BIGINT NOT NULL, person_id BIGINT NOT NULL,
        observation_period_start_date TIMESTAMP NOT NULL, observation_period_end_date TIMESTAMP
        NOT NULL, period_type_concept_id BIGINT NOT NULL
    """,
    "visit_occurrence": """
        visit_occurrence_id BIGINT NOT NULL, person_id BIGINT NOT NULL, visit_concept_id BIGINT
        NOT NULL, visit_start_date TIMESTAMP NOT NULL, visit_start_timestamp TIMESTAMP,
        visit_end_date TIMESTAMP NOT NULL, visit_end_timestamp TIMESTAMP, visit_type_concept_id
        BIGINT NOT NULL, provider_id BIGINT, care_site_id BIGINT, visit_source_value STRING,
        visit_source_concept_id BIGINT, admitted_from_concept_id BIGINT,
        admitted_from_source_value STRING, discharged_to_concept_id BIGINT,
        discharged_to_source_value STRING, preceding_visit_occurrence_id BIGINT
    """,
    "visit_detail": """
        visit_detail_id BIGINT NOT NULL, person_id BIGINT NOT NULL, visit_detail_concept_id
        BIGINT NOT NULL, visit_detail_start_date TIMESTAMP NOT NULL,
        visit_detail_start_timestamp TIMESTAMP, visit_detail_end_date TIMESTAMP NOT NULL,
        visit_detail_end_timestamp TIMESTAMP, visit_detail_type_concept_id BIGINT NOT NULL,
        provider_id BIGINT, care_site_id BIGINT, visit_detail_source_value STRING,
        visit_detail_source_concept_id BIGINT, admitted_from_concept_id BIGINT,
        admitted_from_source_value STRING, discharged_to_source_value STRING,
        discharged_to_concept_id BIGINT, preceding_visit_detail_id BIGINT,
        parent_visit_detail_id BIGINT, visit_occurrence_id BIGINT NOT NULL
    """,
    "condition_occurrence": """
        condition_occurrence_id BIGINT NOT NULL, person_id BIGINT NOT NULL, condition_concept_id
        BIGINT NOT NULL, condition_start_date TIMESTAMP NOT NULL, condition_start_timestamp
        TIMESTAMP, condition_end_date TIMESTAMP, condition_end_timestamp TIMESTAMP,
        condition_type_concept_id BIGINT NOT NULL, condition_status_concept_id BIGINT,
        stop_reason STRING, provider_id BIGINT, visit_occurrence_id BIGINT, visit_detail_id
        BIGINT, condition_source_value STRING, condition_source_concept_id BIGINT,
        condition_status_source_value STRING
    """,
    "drug_exposure": """
        drug_exposure_id BIGINT NOT NULL, person_id BIGINT NOT NULL, drug_concept_id BIGINT NOT
        NULL, drug_exposure_start_date TIMESTAMP NOT NULL, drug_exposure_start_timestamp
        TIMESTAMP, drug_exposure_end_date TIMESTAMP NOT NULL, drug_exposure_end_timestamp
        TIMESTAMP, verbatim_end_date TIMESTAMP, drug_type_concept_id BIGINT NOT NULL,
        stop_reason STRING, refills INT, quantity FLOAT, days_supply INT, sig STRING,
        route_concept_id BIGINT, lot_number STRING, provider_id BIGINT, visit_occurrence_id
        BIGINT, visit_detail_id BIGINT, drug_source_value STRING, drug_source_concept_id BIGINT,
        route_source_value STRING, dose_unit_source_value STRING
    """,
    "procedure_occurrence": """
        procedure_occurrence_id BIGINT NOT NULL, person_id BIGINT NOT NULL, procedure_concept_id
        BIGINT NOT NULL, procedure_date TIMESTAMP NOT NULL, procedure_timestamp TIMESTAMP,
        procedure_end_date TIMESTAMP, procedure_end_timestamp TIMESTAMP,
        procedure_type_concept_id BIGINT NOT NULL, modifier_concept_id BIGINT, quantity INT,
        provider_id BIGINT, visit_occurrence_id BIGINT, visit_detail_id BIGINT,
        procedure_source_value STRING, procedure_source_concept_id BIGINT, modifier_source_value
        STRING
    """,
    "device_exposure": """
        device_exposure_id BIGINT NOT NULL, person_id BIGINT NOT NULL, device_concept_id BIGINT
        NOT NULL, device_exposure_start_date TIMESTAMP NOT NULL, device_exposure_start_timestamp
        TIMESTAMP, device_exposure_end_date TIMESTAMP, device_exposure_end_timestamp TIMESTAMP,
        device_type_concept_id BIGINT NOT NULL, unique_device_id STRING, production_id STRING,
        quantity INT, provider_id BIGINT, visit_occurrence_id BIGINT, visit_detail_id BIGINT,
        device_source_value STRING, device_source_concept_id BIGINT, unit_concept_id BIGINT,
        unit_source_value STRING, unit_source_concept_id BIGINT
    """,
    "measurement": """
        measurement_id BIGINT NOT NULL, person_id BIGINT NOT NULL, measurement_concept_id BIGINT
        NOT NULL, measurement_date TIMESTAMP NOT NULL, measurement_timestamp TIMESTAMP,
        measurement_time STRING, measurement_type_concept_id BIGINT NOT NULL,
        operator_concept_id BIGINT, value_as_number FLOAT, value_as_concept_id BIGINT,
        unit_concept_id BIGINT, range_low FLOAT, range_high FLOAT, provider_id BIGINT,
        visit_occurrence_id BIGINT, visit_detail_id BIGINT, measurement_source_value STRING,
        measurement_source_concept_id BIGINT, unit_source_value STRING, unit_source_concept_id
        BIGINT, value_source_value STRING, measurement_event_id BIGINT,
        meas_event_field_concept_id BIGINT
    """,
    "observation": """
        observation_id BIGINT NOT NULL, person_id BIGINT NOT NULL, observation_concept_id BIGINT
        NOT NULL, observation_date TIMESTAMP NOT NULL, observation_timestamp TIMESTAMP,
        observation_type_concept_id BIGINT NOT NULL, value_as_number FLOAT, value_as_string
        STRING, value_as_concept_id BIGINT, qualifier_concept_id BIGINT, unit_concept_id BIGINT,
        provider_id BIGINT, visit_occurrence_id BIGINT, visit_detail_id BIGINT,
        observation_source_value STRING, observation_source_concept_id BIGINT, unit_source_value
        STRING, qualifier_source_value STRING, value_source_value STRING, observation_event_id
        BIGINT, obs_event_field_concept_id BIGINT
    """,
    "death": """
        person_id BIGINT NOT NULL, death_date TIMESTAMP NOT NULL, death_timestamp TIMESTAMP,
        death_type_concept_id BIGINT, cause_concept_id BIGINT, cause_source_value STRING,
        cause_source_concept_id BIGINT
    """,
    "note": """
        note_id BIGINT NOT NULL, person_id BIGINT NOT NULL, note_date TIMESTAMP NOT NULL,
        note_timestamp TIMESTAMP, note_type_concept_id BIGINT NOT NULL, note_class_concept_id
        BIGINT NOT NULL, note_title STRING, note_text STRING NOT NULL, encoding_concept_id
        BIGINT NOT NULL, language_concept_id BIGINT NOT NULL, provider_id BIGINT,
        visit_occurrence_id BIGINT, visit_detail_id BIGINT, note_source_value STRING,
        note_event_id BIGINT, note_event_field_concept_id BIGINT
    """,
    "note_nlp": """
        note_nlp_id BIGINT NOT NULL, note_id BIGINT NOT NULL, section_concept_id BIGINT, snippet
        STRING, offset STRING, lexical_variant STRING NOT NULL, note_nlp_concept_id BIGINT,
        note_nlp_source_concept_id BIGINT, nlp_system STRING, nlp_date TIMESTAMP NOT NULL,
        nlp_timestamp TIMESTAMP, term_exists STRING, term_temporal STRING, term_modifiers STRING
    """,
    "specimen": """
        specimen_id BIGINT NOT NULL, person_id BIGINT NOT NULL, specimen_concept_id BIGINT NOT
        NULL, specimen_type_concept_id BIGINT NOT NULL, specimen_date TIMESTAMP NOT NULL,
        specimen_timestamp TIMESTAMP, quantity FLOAT, unit_concept_id BIGINT,
        anatomic_site_concept_id BIGINT, disease_status_concept_id BIGINT, specimen_source_id
        STRING, specimen_source_value STRING, unit_source_value STRING,
        anatomic_site_source_value STRING, disease_status_source_value STRING
    """,
    "fact_relationship": """
        domain_concept_id_1 INT NOT NULL, fact_id_1 INT NOT NULL, domain_concept_id_2 INT NOT
        NULL, fact_id_2 INT NOT NULL, relationship_concept_id BIGINT NOT NULL
    """,
    "location": """
        location_id BIGINT NOT NULL, address_1 STRING, address_2 STRING, city STRING, state
        STRING, zip STRING, county STRING, location_source_value STRING, country_concept_id
        BIGINT, country_source_value STRING, latitude FLOAT, longitude FLOAT
    """,
    "care_site": """
        care_site_id BIGINT NOT NULL, care_site_name STRING, place_of_service_concept_id BIGINT,
        location_id BIGINT, care_site_source_value STRING, place_of_service_source_value STRING
    """,
    "provider": """
        provider_id BIGINT NOT NULL, provider_name STRING, npi STRING, dea STRING,
        specialty_concept_id BIGINT, care_site_id BIGINT, year_of_birth INT, gender_concept_id
        BIGINT, provider_source_value STRING, specialty_source_value STRING,
        specialty_source_concept_id BIGINT, gender_source_value STRING, gender_source_concept_id
        BIGINT
    """,
    "payer_plan_period": """
        payer_plan_period_id BIGINT NOT NULL, person_id BIGINT NOT NULL,
        payer_plan_period_start_date TIMESTAMP NOT NULL, payer_plan_period_end_date TIMESTAMP
        NOT NULL, payer_concept_id BIGINT, payer_source_value STRING, payer_source_concept_id
        BIGINT, plan_concept_id BIGINT, plan_source_value STRING, plan_source_concept_id BIGINT,
        sponsor_concept_id BIGINT, sponsor_source_value STRING, sponsor_source_concept_id
        BIGINT, family_source_value STRING, stop_reason_concept_id BIGINT,
        stop_reason_source_value STRING, stop_reason_source_concept_id BIGINT
    """,
    "cost": """
        cost_id BIGINT NOT NULL, cost_event_id BIGINT NOT NULL, cost_domain_id STRING NOT NULL,
        cost_type_concept_id BIGINT NOT NULL, currency_concept_id BIGINT, total_charge FLOAT,
        total_cost FLOAT, total_paid FLOAT, paid_by_payer FLOAT, paid_by_patient FLOAT,
        paid_patient_copay FLOAT, paid_patient_coinsurance FLOAT, paid_patient_deductible FLOAT,
        paid_by_primary FLOAT, paid_ingredient_cost FLOAT, paid_dispensing_fee FLOAT,
        payer_plan_period_id BIGINT, amount_allowed FLOAT, revenue_code_concept_id BIGINT,
        revenue_code_source_value STRING, drg_concept_id BIGINT, drg_source_value STRING
    """,
    "drug_era": """
        drug_era_id BIGINT NOT NULL, person_id BIGINT NOT NULL, drug_concept_id BIGINT NOT NULL,
        drug_era_start_date TIMESTAMP NOT NULL, drug_era_end_date TIMESTAMP NOT NULL,
        drug_exposure_count INT, gap_days INT
    """,
    "dose_era": """
        dose_era_id BIGINT NOT NULL, person_id BIGINT NOT NULL, drug_concept_id BIGINT NOT NULL,
        unit_concept_id BIGINT NOT NULL, dose_value FLOAT NOT NULL, dose_era_start_date
        TIMESTAMP NOT NULL, dose_era_end_date TIMESTAMP NOT NULL
    """,
    "condition_era": """
        condition_era_id BIGINT NOT NULL, person_id BIGINT NOT NULL, condition_concept_id BIGINT
        NOT NULL, condition_era_start_date TIMESTAMP NOT NULL, condition_era_end_date TIMESTAMP
        NOT NULL, condition_occurrence_count INT
    """,
    "episode": """
        episode_id BIGINT NOT NULL, person_id BIGINT NOT NULL, episode_concept_id BIGINT NOT
        NULL, episode_start_date TIMESTAMP NOT NULL, episode_start_timestamp TIMESTAMP,
        episode_end_date TIMESTAMP, episode_end_timestamp TIMESTAMP, episode_parent_id BIGINT,
        episode_number INT, episode_object_concept_id BIGINT NOT NULL, episode_type_concept_id
        BIGINT NOT NULL, episode_source_value STRING, episode_source_concept_id BIGINT
    """,
    "episode_event": """
        episode_id BIGINT NOT NULL, event_id BIGINT NOT NULL, episode_event_field_concept_id
        BIGINT NOT NULL
    """,
    "metadata": """
        metadata_id BIGINT NOT NULL, metadata_concept_id BIGINT NOT NULL,
        metadata_type_concept_id BIGINT NOT NULL, name STRING NOT NULL, value_as_string STRING,
        value_as_concept_id BIGINT, value_as_number FLOAT, metadata_date TIMESTAMP,
        metadata_timestamp TIMESTAMP
    """,
    "cdm_source": """
        cdm_source_name STRING NOT NULL, cdm_source_abbreviation STRING NOT NULL, cdm_holder
        STRING NOT NULL, source_description STRING, source_documentation_reference STRING,
        cdm_etl_reference STRING, source_release_date TIMESTAMP NOT NULL, cdm_release_date
        TIMESTAMP NOT NULL, cdm_version STRING, cdm_version_concept_id BIGINT NOT NULL,
        vocabulary_version STRING NOT NULL
    """,
    "concept": """
        concept_id BIGINT NOT NULL, concept_name STRING NOT NULL, domain_id STRING NOT NULL,
        vocabulary_id STRING NOT NULL, concept_class_id STRING NOT NULL, standard_concept
        STRING, concept_code STRING NOT NULL, valid_start_date TIMESTAMP NOT NULL,
        valid_end_date TIMESTAMP NOT NULL, invalid_reason STRING
    """,
    "vocabulary": """
        vocabulary_id STRING NOT NULL, vocabulary_name STRING NOT NULL, vocabulary_reference
        STRING, vocabulary_version STRING, vocabulary_concept_id BIGINT NOT NULL
    """,
    "domain": """
        domain_id STRING NOT NULL, domain_name STRING NOT NULL, domain_concept_id BIGINT NOT
        NULL
    """,
    "concept_class": """
        concept_class_id STRING NOT NULL, concept_class_name STRING NOT NULL,
        concept_class_concept_id BIGINT NOT NULL
    """,
    "concept_relationship": """
        concept_id_1 BIGINT NOT NULL, concept_id_2 BIGINT NOT NULL, relationship_id STRING NOT
        NULL, valid_start_date TIMESTAMP NOT NULL, valid_end_date TIMESTAMP NOT NULL,
        invalid_reason STRING
    """,
    "relationship": """
        relationship_id STRING NOT NULL, relationship_name STRING NOT NULL, is_hierarchical
        STRING NOT NULL, defines_ancestry STRING NOT NULL, reverse_relationship_id STRING NOT
        NULL, relationship_concept_id BIGINT NOT NULL
    """,
    "concept_synonym": """
        concept_id BIGINT NOT NULL, concept_synonym_name STRING NOT NULL, language_concept_id
        BIGINT NOT NULL
    """,
    "concept_ancestor": """
        ancestor_concept_id BIGINT NOT NULL, descendant_concept_id BIGINT NOT NULL,
        min_levels_of_separation INT NOT NULL, max_levels_of_separation INT NOT NULL
    """,
    "source_to_concept_map": """
        source_code STRING NOT NULL, source_concept_id BIGINT NOT NULL, source_vocabulary_id
        STRING NOT NULL, source_code_description STRING, target_concept_id BIGINT NOT NULL,
        target_vocabulary_id STRING NOT NULL, valid_start_date TIMESTAMP NOT NULL,
        valid_end_date TIMESTAMP NOT NULL, invalid_reason STRING
    """,
    "drug_strength": """
        drug_concept_id BIGINT NOT NULL, ingredient_concept_id BIGINT NOT NULL, amount_value
        FLOAT, amount_unit_concept_id BIGINT, numerator_value FLOAT, numerator_unit_concept_id
        BIGINT, denominator_value FLOAT, denominator_unit_concept_id BIGINT, box_size INT,
        valid_start_date TIMESTAMP NOT NULL, valid_end_date TIMESTAMP NOT NULL, invalid_reason
        STRING
    """,
    "cohort": """
        cohort_definition_id BIGINT NOT NULL, subject_id BIGINT NOT NULL, cohort_start_date
        TIMESTAMP NOT NULL, cohort_end_date TIMESTAMP NOT NULL
    """,
    "cohort_definition": """
        cohort_definition_id BIGINT NOT NULL, cohort_definition_name STRING NOT NULL,
        cohort_definition_description STRING, definition_type_concept_id BIGINT NOT NULL,
        cohort_definition_syntax STRING, subject_concept_id BIGINT NOT NULL,
        cohort_initiation_date TIMESTAMP
    """,
    "datasus_person": """
        person_id BIGINT NOT NULL, system_source_id INT NOT NULL, datasus_person_source_date
        DATE NOT NULL, ingestion_timestamp TIMESTAMP NOT NULL, source_file STRING NOT NULL,
        mother_birth_date DATE, mother_birth_date_source_value STRING, mother_years_of_study
        STRING, mother_education_level STRING, mother_education_level_aggregated STRING,
        mother_marital_status STRING, mother_age INT, mother_city_of_birth INT,
        mother_state_of_birth INT, mother_race STRING, mother_elementary_school INT, father_age
        INT, responsible_document_type INT, responsible_role_type INT,
        place_of_birth_type_source_value STRING, care_site_of_birth_source_value INT,
        mother_professional_occupation STRING, mother_country_of_origin INT,
        number_of_dead_children INT, number_of_living_children INT,
        number_of_previous_pregnancies INT, number_of_previous_cesareans INT,
        number_of_previous_normal_born INT
    """,
    "datasus_death": """
        person_id BIGINT NOT NULL, system_source_id INT NOT NULL, datasus_person_source_date
        DATE NOT NULL, ingestion_timestamp TIMESTAMP NOT NULL, source_file STRING NOT NULL,
        defunct_job_related_death INT, death_reason_changed INT, defunct_in_continuous_treatment
        INT, defunct_city_of_birth INT, defunct_city_of_death INT, autopsy_city INT,
        death_investigation_date TIMESTAMP, defunct_years_of_study STRING,
        defunct_education_level STRING, defunct_education_level_aggregated STRING,
        mother_years_of_study STRING, mother_education_level STRING,
        mother_education_level_aggregated STRING, defunct_marital_status STRING, defunct_age
        INT, mother_age INT, birth_death INT, defunct_main_occupation INT,
        mother_professional_occupation STRING, number_of_dead_children INT,
        number_of_living_children INT, defunct_elementary_school INT, mother_elementary_school
        INT, death_investigation_level STRING, death_occurrence_time INT, death_investigated
        STRING, death_additional_info INT, information_source STRING, investigation_source INT,
        investigation_register_date TIMESTAMP, investigation_case_conclusion_date TIMESTAMP,
        investigation_conclusion_date TIMESTAMP, investigation_date TIMESTAMP,
        type_place_of_death INT, death_occurrence_time_2012 INT, death_cause_original STRING,
        death_cause_previous STRING, physician_id STRING
    """,
    "datasus_climate": """
        location_id BIGINT, city_code STRING, city_name STRING, state_code STRING,
        state_abbreviation STRING, state_name STRING, region_code FLOAT, region_name STRING,
        measurement_date STRING
    """,
}


def _field(text: str) -> T.StructField:
    name, kind, *required = text.split()
    return T.StructField(name, _TYPES[kind], not required)


TABLES: dict[str, T.StructType] = {
    table: T.StructType([_field(text) for text in columns.split(",")])
    for table, columns in _TABLES.items()
}
# the climate table goes on with a column for each statistic and pollutant
for _name in [
    *(f"{v}_{s}_value" for v in CLIMATE_VARIABLES for s in CLIMATE_STATISTICS),
    *POLLUTANTS,
]:
    TABLES["datasus_climate"].add(_name, T.FloatType())


def table_schema(table: str) -> T.StructType:
    """Schema of one registered table."""
    return TABLES[table]


def required_columns(schema: T.StructType) -> list[str]:
    """Columns that may not be null."""
    return [field.name for field in schema.fields if not field.nullable]
