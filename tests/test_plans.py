"""Births, deaths, dimensions and climate on small records, with the repaired behaviours."""

import datetime as dt

import pytest
import records
from pyspark.sql import functions as F

from vitalspan.operators import contract
from vitalspan.operators.conform import conform
from vitalspan.operators.lookup import attach_care_site, attach_city, city_rows
from vitalspan.operators.unpivot import Cell, unpivot_cells
from vitalspan.plans import births, climate, deaths, dimensions, mappings, mortality, vocabulary
from vitalspan.schemas import TABLES, required_columns, table_schema


def keyed(frame):
    return frame.withColumn("person_id", F.lit(1).cast("long")).withColumn(
        "source_file", F.lit("f")
    )


def location(spark, rows):
    return spark.createDataFrame(
        rows, "location_id long, city string, county string, location_source_value string"
    )


def care_site(spark, rows):
    return spark.createDataFrame(rows, "care_site_id long, care_site_source_value string")


CITIES = [(7, "A", "12", "1200401"), (8, "B", None, "1200402")]


def test_registry():
    assert len(TABLES) == 42
    assert len(table_schema("datasus_climate")) == 55
    assert len(table_schema("datasus_person")) == 28
    assert len(table_schema("datasus_death")) == 43
    assert required_columns(table_schema("death")) == ["person_id", "death_date"]
    assert table_schema("measurement")["measurement_time"].dataType.simpleString() == "string"


def test_sample_birth_becomes_a_person(spark):
    raw = records.births(spark, [{"RACACOR": "1", "CODESTAB": "2515598"}])
    accepted, rejected = births.accepted_births(raw)
    assert rejected.isEmpty()
    row = births.person(
        keyed(accepted), location(spark, CITIES), care_site(spark, [(5, "2515598")])
    ).first()
    assert (row.gender_concept_id, row.race_concept_id) == (8507, 3212942)
    assert (row.year_of_birth, row.month_of_birth, row.day_of_birth) == (2010, 5, 7)
    assert row.birth_timestamp == dt.datetime(2010, 5, 7, 11, 55)
    assert (row.location_id, row.care_site_id) == (7, 5)


def test_bad_records_are_dropped_or_set_aside(spark):
    raw = records.births(
        spark,
        [{}, {"DTNASC": None}, {"DTNASC": "7052010"}, {"DTNASC": "32132010"}],
    )
    accepted, rejected = births.accepted_births(raw)
    assert accepted.count() == 1
    assert [r.missing_columns for r in rejected.collect()] == ["event_ts"]


def test_fact_dates_keep_their_month(spark):
    accepted, _ = births.accepted_births(records.births(spark, [{"GESTACAO": "5"}]))
    facts = births.condition_occurrence(keyed(accepted))
    days = {r.condition_start_date for r in facts.collect()}
    assert days == {dt.datetime(2010, 5, 7)}


def test_one_fact_per_present_column_even_when_empty(spark):
    raw = records.births(spark, [{"PESO": "3400", "APGAR1": "x"}, {}], without=["TPROBSON"])
    accepted, _ = births.accepted_births(raw)
    rows = births.measurement(keyed(accepted)).collect()
    assert len(rows) == 2 * 3
    numbers = {r.measurement_source_value: r.value_as_number for r in rows}
    assert numbers["3400"] == 3400.0 and numbers["x"] is None


def test_empty_cells_can_be_dropped(spark):
    frame = spark.createDataFrame([(1, "a", None), (2, None, "b")], "id int, x string, y string")
    cells = [Cell("x", 10), Cell("y", 20)]
    kept = unpivot_cells(frame, cells, ["id"], drop_null_cells=True)
    assert sorted((r.id, r.concept_id, r.cell_value) for r in kept.collect()) == [
        (1, 10, "a"),
        (2, 20, "b"),
    ]


def test_absent_optional_family_gives_no_rows(spark):
    accepted, _ = births.accepted_births(records.births(spark, [{}], without=["PARIDADE"]))
    facts = births.observation(keyed(accepted))
    assert facts.isEmpty() and facts.columns == table_schema("observation").names


def test_absent_required_column_is_an_error(spark):
    accepted, _ = births.accepted_births(records.births(spark, [{}], without=["PARTO"]))
    with pytest.raises(ValueError, match="PARTO"):
        births.procedure_occurrence(keyed(accepted))


def test_extension_pads_optional_columns(spark):
    raw = records.births(
        spark, [{"IDADEMAE": "24", "DTNASCMAE": "01021986"}], without=["CODUFNATU", "ESCMAE2010"]
    )
    accepted, _ = births.accepted_births(raw)
    row = births.extension(keyed(accepted)).first()
    assert row.mother_age == 24 and row.mother_birth_date == dt.date(1986, 2, 1)
    assert row.mother_state_of_birth is None and row.mother_education_level is None


def test_death_periods_belong_to_their_person(spark):
    raw = records.deaths(spark, [{"DTATESTADO": "99999999", "DTCADASTRO": "10052012"}])
    accepted, _ = deaths.accepted_deaths(raw)
    one = keyed(accepted).withColumn("person_id", F.lit(40).cast("long"))
    rows = deaths.observation_period(one, 40, 9).orderBy("observation_period_id").collect()
    assert [(r.observation_period_id, r.person_id) for r in rows] == [(9, 40), (10, 40)]
    assert [r.observation_period_start_date for r in rows] == [
        dt.datetime(2012, 5, 8),
        dt.datetime(2012, 5, 10),
    ]


def test_death_person_and_record(spark):
    accepted, _ = deaths.accepted_deaths(records.deaths(spark, [{"CAUSABAS": "R193"}]))
    person = deaths.person(keyed(accepted), location(spark, CITIES), care_site(spark, [])).first()
    assert (person.year_of_birth, person.month_of_birth) == (2010, None)
    assert person.birth_timestamp == dt.datetime(2010, 5, 7)
    record = deaths.death(keyed(accepted)).first()
    assert record.death_date == dt.datetime(2012, 5, 8, 23, 30)
    assert record.cause_source_value == "R193"


def test_cause_lines_carry_their_name(spark):
    accepted, _ = deaths.accepted_deaths(records.deaths(spark, [{"LINHAB": "J18"}]))
    rows = deaths.procedure_occurrence(keyed(accepted)).collect()
    assert len(rows) == len(mappings.DEATH_PROCEDURES)
    line = [r for r in rows if r.modifier_source_value == "LINHAB"]
    assert line[0].procedure_source_value == "J18"
    assert sum(r.modifier_source_value is None for r in rows) == 5


def test_investigation_level_stays_text(spark):
    accepted, _ = deaths.accepted_deaths(records.deaths(spark, [{"TPNIVELINV": "E"}]))
    assert deaths.extension(keyed(accepted)).first().death_investigation_level == "E"


def test_duplicate_dimension_rows_do_not_multiply_records(spark):
    frame = spark.createDataFrame([("120040", "9")], "CODMUNRES string, CODESTAB string")
    cities = location(spark, [(9, "A", "12", "1200401"), (7, "A", "12", "1200401")])
    sites = care_site(spark, [(4, "9"), (3, "9")])
    rows = attach_care_site(attach_city(frame, cities), sites).collect()
    assert [(r.location_id_city, r.care_site_id) for r in rows] == [(7, 3)]


def test_facility_addresses_are_no_cities(spark):
    assert [r.location_id for r in city_rows(location(spark, CITIES)).collect()] == [7]


def test_conform_rejects_unknown_targets(spark):
    with pytest.raises(ValueError, match="nonsense"):
        conform(spark.range(1), table_schema("death"), {"nonsense": F.lit(1)})


def test_conform_takes_expressions_as_text(spark):
    row = conform(spark.range(3, 4), table_schema("death"), {"person_id": "id * 2"}).first()
    assert row.person_id == 6 and row.death_date is None


def test_violations(spark):
    frame = spark.createDataFrame(
        [(1, None), (2, None), (None, None)], "person_id long, death_date timestamp"
    )
    rows = contract.violations(frame, table_schema("death")).collect()
    assert {r.column_name: r.null_rows for r in rows} == {"person_id": 1, "death_date": 3}


def test_cities(spark):
    raw = spark.createDataFrame(
        [
            ("1", "B", "1200054", "-69,5", "-10,25", 0),
            ("2", "A", "1200013", "-66,8", "-9,75", 1),
            ("3", "nowhere", "9900013", "0", "0", 2),
        ],
        "OID_ string, nome string, geocodigo string, Longitude string, Latitude string,"
        " source_row long",
    )
    rows = dimensions.city_locations(raw, 50).orderBy("location_id").collect()
    assert [(r.location_id, r.city, r.state, r.county) for r in rows] == [
        (50, "A", "Acre", "12"),
        (51, "B", "Acre", "12"),
    ]
    assert rows[0].latitude == -9.75


def test_seeds(spark):
    sites = dimensions.seed_care_sites(spark).orderBy("care_site_id").collect()
    assert [(r.care_site_id, r.place_of_service_concept_id) for r in sites] == [
        (3, 43021744),
        (4, 45881550),
    ]
    providers = dimensions.seed_providers(spark).collect()
    assert {r.provider_id: r.specialty_source_concept_id for r in providers} == {
        1: 1,
        2: 2,
        3: 3,
        4: 4,
        5: 9,
    }


def climate_row(spark, **extra):
    values = {"code_muni": "1200401", "code_state": "12", "abbrev_state": "AC"}
    values["date"] = "2010-01-01"
    for variable in ("TMIN", "TMAX", "PR", "ETo", "RH", "Rs", "u2"):
        for statistic in ("mean", "min", "max", "stdev"):
            values[f"{variable}_{statistic}"] = 1.0
    values.update(PR_sum=2.0, ETo_sum=3.0)
    pollutants = "c2h6 ch3coch3 ch4 co co2s hcl mmrpm10 mmrpm2p5 no2 sfo3max so2".split()
    values.update({name: float(i) for i, name in enumerate(pollutants)})
    values.update(extra)
    return spark.createDataFrame([tuple(values.values())], list(values))


def test_climate_binds_pollutants_by_name(spark):
    row = climate.conform_climate(climate_row(spark), location(spark, CITIES)).first()
    assert (row.carbon_monoxide_co, row.carbon_dioxide_co2s) == (3.0, 4.0)
    assert (row.state_name, row.region_code, row.region_name) == ("Acre", 1.0, "Norte")
    assert row.precipitation_sum_value == 2.0 and row.wind_speed_sum_value is None


def test_climate_prefers_names_of_the_source(spark):
    source = climate_row(spark, name_state="AC!", code_region="9", name_region="N!")
    row = climate.conform_climate(source, location(spark, CITIES)).first()
    assert (row.state_name, row.region_code, row.region_name) == ("AC!", 9.0, "N!")


def test_climate_of_an_unknown_city(spark):
    row = climate.conform_climate(climate_row(spark), location(spark, [])).first()
    assert (row.location_id, row.state_name, row.city_code) == (None, None, "1200401")


def test_flat_climate_needs_all_columns(spark):
    with pytest.raises(ValueError, match="n_days_TN10p"):
        climate.flat_climate(climate_row(spark))
    assert len(climate.FLAT_SCHEMA) == 40


def events(spark, rows):
    return spark.createDataFrame(
        rows, "location_id long, birth_timestamp timestamp, death_timestamp timestamp"
    )


def test_mortality(spark):
    cities = location(spark, [(1, "A", "12", "x"), (2, "B", "12", "y"), (3, "C", "99", "z")])
    day = dt.datetime(2019, 6, 1)
    born = events(
        spark,
        [(1, day, None)] * 60 + [(2, day, None)] * 40 + [(3, day, None)]
        + [(1, dt.datetime(2018, 12, 31, 23, 59), None)],
    ).drop("death_timestamp")
    died = events(
        spark,
        [
            (1, day - dt.timedelta(days=365), day),
            (2, day - dt.timedelta(days=366), day),
            (2, day - dt.timedelta(days=1826), day),
            (1, day + dt.timedelta(days=3), day),
        ],
    )
    rows = mortality.mortality_rates(born, died, cities, 2019).collect()
    assert [r.iso_estado for r in rows] == ["BR-AC", "Desconhecido"]
    assert (rows[0].taxa_mortalidade_0_1_ano, rows[0].taxa_mortalidade_0_5_anos) == (10.0, 20.0)
    assert rows[0].categoria_mortalidade_0_5_anos_num == 5
    assert rows[1].taxa_mortalidade_0_1_ano == 0.0
    counts = mortality.deaths_by_state(died, cities, 2019).collect()
    assert counts[0].deaths_before_birth == 1


def test_codes_match_without_dots(spark):
    concept = spark.createDataFrame(
        [(2, "ICD", "R19.3"), (1, "ICD", "R193"), (3, "other", "A00")],
        "concept_id long, vocabulary_id string, concept_code string",
    )
    codes = spark.createDataFrame([("R193",), ("R19.3",), ("A00",), (None,)], "code string")
    rows = vocabulary.code_to_concept(codes, "code", concept, "ICD").collect()
    assert sorted((r.code or "", r.concept_id) for r in rows) == [
        ("", None),
        ("A00", None),
        ("R19.3", 1),
        ("R193", 1),
    ]


def test_vocabulary_lines_that_do_not_fit(spark, tmp_path):
    header = "\t".join(vocabulary.file_schema("CONCEPT").names)
    good = '45\tAspirin "forte"\tDrug\tRx\tIng\tS\t0012\t19700101\t20991231\t'
    bad_id = good.replace("45", "x", 1)
    bad_date = good.replace("19700101", "19701301")
    (tmp_path / "CONCEPT.csv").write_text("\n".join([header, good, bad_id, bad_date]) + "\n")
    (tmp_path / "README.csv").write_text("x\n")
    assert vocabulary.files_in(spark, str(tmp_path)) == ["CONCEPT"]
    accepted, rejected = vocabulary.read_vocabulary(spark, str(tmp_path), "CONCEPT")
    row = accepted.first()
    assert accepted.count() == 1 and row.concept_code == "0012"
    assert [r.concept_code for r in accepted.select("concept_code").collect()] == ["0012"]
    assert row.concept_name == 'Aspirin "forte"'
    assert row.valid_start_date == dt.datetime(1970, 1, 1) and row.invalid_reason is None
    assert sorted(r.missing_columns for r in rejected.collect()) == [
        "_corrupt_record",
        "valid_start_date",
    ]


def test_a_lookup_too_large_to_broadcast_gives_the_same(spark, monkeypatch):
    from vitalspan.operators import lookup

    frame = spark.createDataFrame([("120040",), ("999999",), (None,)], "CODMUNRES string")
    small = attach_city(frame, location(spark, CITIES))
    monkeypatch.setattr(lookup, "MAX_BROADCAST_ROWS", 0)
    large = attach_city(frame, location(spark, CITIES))
    for joined in (small, large):
        rows = sorted((r.CODMUNRES or "", r.location_id_city) for r in joined.collect())
        assert rows == [("", None), ("120040", 7), ("999999", None)]
