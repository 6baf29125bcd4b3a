"""DuckDB equivalents of the registered queries.

Only the shaping of the raw records is shared with the Spark side; every rule under test is
written here a second time, in plain SQL.
"""

from __future__ import annotations

from fixtures import adapters

YEAR = 1998
U = adapters.state_of

def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_VALID_CLOCK = "regexp_full_match({c}, '([01][0-9]|2[0-3])[0-5][0-9]')"


def _clock(column: str) -> str:
    return f"CASE WHEN {_VALID_CLOCK.format(c=column)} THEN {column} ELSE '0000' END"


# DuckDB numbers the rows of an unordered scan in file order
PLACED = """placed_orders AS (SELECT row_number() OVER () AS position, * FROM orders),
placed_lineitem AS (SELECT row_number() OVER () AS position, * FROM lineitem)"""
RAW_BIRTHS = f"{PLACED},\nraw_births AS ({adapters.births_sql(adapters.DUCKDB)})"
CLEAN_BIRTHS = f"""clean_births AS (
  SELECT * REPLACE ({_clock("HORANASC")} AS HORANASC),
    try_strptime(DTNASC || {_clock("HORANASC")}, '%d%m%Y%H%M') AS event_ts
  FROM raw_births WHERE regexp_full_match(DTNASC, '[0-9]{{8}}'))"""
BIRTHS = """births AS (
  SELECT position AS person_id, * FROM clean_births WHERE event_ts IS NOT NULL)"""
DENSE_BIRTHS = """births AS (
  SELECT row_number() OVER (ORDER BY rec_id) AS person_id, *
  FROM clean_births WHERE event_ts IS NOT NULL)"""
BORN = (RAW_BIRTHS, CLEAN_BIRTHS, BIRTHS)

RAW_DEATHS = f"raw_deaths AS ({adapters.deaths_sql(adapters.DUCKDB)})"
CLEAN_DEATHS = f"""clean_deaths AS (
  SELECT * REPLACE ({_clock("HORAOBITO")} AS HORAOBITO),
    try_strptime(DTOBITO || {_clock("HORAOBITO")}, '%d%m%Y%H%M') AS death_ts,
    try_strptime(DTNASC, '%d%m%Y') AS birth_ts
  FROM raw_deaths WHERE regexp_full_match(DTOBITO, '[0-9]{{8}}'))"""
DEATHS = """deaths AS (
  SELECT position AS person_id, * FROM clean_deaths WHERE death_ts IS NOT NULL)"""
DENSE_DEATHS = f"""deaths AS (
  SELECT row_number() OVER (ORDER BY {", ".join(adapters.DEATH_KEY)}) AS person_id, *
  FROM clean_deaths WHERE death_ts IS NOT NULL)"""
PLACED_DEATHS = f"{PLACED},\n{RAW_DEATHS}"
DIED = (PLACED_DEATHS, CLEAN_DEATHS, DEATHS)

CITY = f"""city AS (
  SELECT n_nationkey + 1 AS location_id, n_name AS city, {U("n_nationkey")} AS county,
    {U("n_nationkey")} || lpad(n_nationkey::VARCHAR, 4, '0') || (n_nationkey % 10)::VARCHAR
      AS location_source_value
  FROM nation)"""

# fixed values: the states, the bands of rates, and below the cells and targets of the facts
STATES = """states (state_name, state_code, uf, region_code, region_name) AS (VALUES
  ('Acre','12','AC',1,'Norte'), ('Alagoas','27','AL',2,'Nordeste'), ('Amapá','16','AP',1,'Norte'),
  ('Amazonas','13','AM',1,'Norte'), ('Bahia','29','BA',2,'Nordeste'),
  ('Ceará','23','CE',2,'Nordeste'), ('Distrito Federal','53','DF',5,'Centro-Oeste'),
  ('Espírito Santo','32','ES',3,'Sudeste'), ('Goiás','52','GO',5,'Centro-Oeste'),
  ('Maranhão','21','MA',2,'Nordeste'), ('Mato Grosso','51','MT',5,'Centro-Oeste'),
  ('Mato Grosso do Sul','50','MS',5,'Centro-Oeste'), ('Minas Gerais','31','MG',3,'Sudeste'),
  ('Pará','15','PA',1,'Norte'), ('Paraíba','25','PB',2,'Nordeste'), ('Paraná','41','PR',4,'Sul'),
  ('Pernambuco','26','PE',2,'Nordeste'), ('Piauí','22','PI',2,'Nordeste'),
  ('Rio Grande do Norte','24','RN',2,'Nordeste'), ('Rio Grande do Sul','43','RS',4,'Sul'),
  ('Rio de Janeiro','33','RJ',3,'Sudeste'), ('Rondônia','11','RO',1,'Norte'),
  ('Roraima','14','RR',1,'Norte'), ('Santa Catarina','42','SC',4,'Sul'),
  ('São Paulo','35','SP',3,'Sudeste'), ('Sergipe','28','SE',2,'Nordeste'),
  ('Tocantins','17','TO',1,'Norte'))"""


def _band(rate: str, first: str, label2: str) -> tuple[str, str]:
    tests = [
        (f"{rate} {first} 11", "< 11,0"),
        (f"{rate} BETWEEN 11 AND 13.0", label2),
        (f"{rate} BETWEEN 13 AND 16.0", "13,1 - 16,0"),
        (f"{rate} BETWEEN 16.1 AND 19.9", "16,1 - 19,9"),
        (f"{rate} > 19.9", "19,9 >"),
    ]
    labels = " ".join(f"WHEN {test} THEN '{label}'" for test, label in tests)
    ordinals = " ".join(f"WHEN {test} THEN {i}" for i, (test, _) in enumerate(tests, 1))
    return f"CASE {labels} ELSE 'Fora do intervalo' END", f"CASE {ordinals} END"


BIRTHS_BY_STATE = f"""births_by_state AS (
  SELECT county AS state, count(*) AS live_births
  FROM births JOIN city ON CODMUNRES = substr(location_source_value, 1, 6)
  WHERE year(event_ts) = {YEAR} GROUP BY county)"""
_AGE = "date_diff('day', birth_ts, death_ts)"
DEATHS_BY_STATE = f"""deaths_by_state AS (
  SELECT county AS state,
    count(*) FILTER ({_AGE} BETWEEN 0 AND 365) AS deaths_0_1,
    count(*) FILTER ({_AGE} BETWEEN 0 AND 1825) AS deaths_0_5,
    count(*) FILTER ({_AGE} < 0) AS deaths_before_birth
  FROM deaths JOIN city ON CODMUNRES = substr(location_source_value, 1, 6)
  WHERE year(death_ts) = {YEAR} GROUP BY county)"""


def _mortality() -> str:
    label1, ordinal1 = _band("taxa_mortalidade_0_1_ano", "<=", "11,1 - 13,1")
    label5, ordinal5 = _band("taxa_mortalidade_0_5_anos", "<", "11,1 - 13,0")
    return (
        _with(
            *BORN,
            RAW_DEATHS,
            CLEAN_DEATHS,
            DEATHS,
            CITY,
            STATES,
            BIRTHS_BY_STATE,
            DEATHS_BY_STATE,
        )
        + f"""SELECT *, {label1} AS categoria_mortalidade_0_1_ano,
  {label5} AS categoria_mortalidade_0_5_anos,
  {ordinal1} AS categoria_mortalidade_0_1_ano_num,
  {ordinal5} AS categoria_mortalidade_0_5_anos_num
FROM (
  SELECT coalesce('BR-' || uf, 'Desconhecido') AS iso_estado,
    round(coalesce(deaths_0_1::DOUBLE * 1000 / live_births, 0), 2) AS taxa_mortalidade_0_1_ano,
    round(coalesce(deaths_0_5::DOUBLE * 1000 / live_births, 0), 2) AS taxa_mortalidade_0_5_anos
  FROM births_by_state b LEFT JOIN deaths_by_state d ON b.state = d.state
    LEFT JOIN states s ON s.state_code = b.state)
ORDER BY iso_estado"""
    )


def _gender(column: str) -> str:
    return (
        f"CASE WHEN {column} IN ('M', '1', 'Masculino') THEN 8507"
        f" WHEN {column} IN ('F', '2', 'Feminino') THEN 8532 ELSE 8551 END::BIGINT"
    )


def _race(column: str) -> str:
    return (
        f"CASE WHEN {column} IN ('1', 'Branca') THEN 3212942"
        f" WHEN {column} IN ('2', 'Preta') THEN 3213733"
        f" WHEN {column} IN ('3', 'Amarela') THEN 3213498"
        f" WHEN {column} IN ('4', 'Parda') THEN 3213487"
        f" WHEN {column} IN ('5', 'Indígena') THEN 3213694 ELSE 763013 END::BIGINT"
    )


def _nulls(type_name: str, *columns: str) -> str:
    return ", ".join(f"NULL::{type_name} AS {column}" for column in columns)


def _person(source: str, year: str, month: str, day: str, ts: str) -> str:
    return f"""SELECT person_id, {_gender("SEXO")} AS gender_concept_id,
  {year} AS year_of_birth, {month} AS month_of_birth, {day} AS day_of_birth,
  {ts} AS birth_timestamp, {_race("RACACOR")} AS race_concept_id,
  38003563::BIGINT AS ethnicity_concept_id, location_id::BIGINT AS location_id,
  s_suppkey AS care_site_id, SEXO AS gender_source_value,
  coalesce(RACACOR, 'Nulo') AS race_source_value,
  {_nulls("BIGINT", "provider_id", "gender_source_concept_id", "race_source_concept_id",
          "ethnicity_source_concept_id")},
  {_nulls("VARCHAR", "person_source_value", "ethnicity_source_value")}
FROM {source} LEFT JOIN city ON CODMUNRES = substr(location_source_value, 1, 6)
  LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier) ON CODESTAB = s_suppkey::VARCHAR"""


def _cell_rows(
    source: str, event: str, cells: list[tuple[str, int]], modifiers: bool = False
) -> str:
    """One UNION ALL branch per source column: the row-per-column form of the facts."""
    width = len(cells)
    branches = [
        f"SELECT (person_id - 1) * {width} + {i} AS fact_id, person_id,"
        f" {concept}::BIGINT AS concept_id, date_trunc('day', {event})::TIMESTAMP AS day,"
        f" {column}::VARCHAR AS cell,"
        f" {repr(column) if modifiers and column.startswith('LINHA') else 'NULL'}::VARCHAR"
        f" AS modifier FROM {source}"
        for i, (column, concept) in enumerate(cells, 1)
    ]
    return "cells AS (" + "\n  UNION ALL ".join(branches) + ")"


def _condition(type_concept: int) -> str:
    return f"""SELECT fact_id AS condition_occurrence_id, person_id,
  concept_id AS condition_concept_id, day AS condition_start_date, day AS condition_end_date,
  {type_concept}::BIGINT AS condition_type_concept_id, cell AS condition_source_value,
  {_nulls("TIMESTAMP", "condition_start_timestamp", "condition_end_timestamp")},
  {_nulls("BIGINT", "condition_status_concept_id", "provider_id", "visit_occurrence_id",
          "visit_detail_id", "condition_source_concept_id")},
  {_nulls("VARCHAR", "stop_reason", "condition_status_source_value")}
FROM cells"""


def _procedure(type_concept: int) -> str:
    return f"""SELECT fact_id AS procedure_occurrence_id, person_id,
  concept_id AS procedure_concept_id, day AS procedure_date, day AS procedure_end_date,
  {type_concept}::BIGINT AS procedure_type_concept_id, cell AS procedure_source_value,
  modifier AS modifier_source_value,
  {_nulls("TIMESTAMP", "procedure_timestamp", "procedure_end_timestamp")},
  {_nulls("BIGINT", "modifier_concept_id", "provider_id", "visit_occurrence_id",
          "visit_detail_id", "procedure_source_concept_id")},
  {_nulls("INTEGER", "quantity")}
FROM cells"""


def _measurement(type_concept: int) -> str:
    return f"""SELECT fact_id AS measurement_id, person_id, concept_id AS measurement_concept_id,
  day AS measurement_date, {type_concept}::BIGINT AS measurement_type_concept_id,
  round(TRY_CAST(cell AS FLOAT)::DOUBLE, 4) AS value_as_number, cell AS measurement_source_value,
  {_nulls("TIMESTAMP", "measurement_timestamp")},
  {_nulls("DOUBLE", "range_low", "range_high")},
  {_nulls("BIGINT", "operator_concept_id", "value_as_concept_id", "unit_concept_id",
          "provider_id", "visit_occurrence_id", "visit_detail_id",
          "measurement_source_concept_id", "unit_source_concept_id", "measurement_event_id",
          "meas_event_field_concept_id")},
  {_nulls("VARCHAR", "measurement_time", "unit_source_value", "value_source_value")}
FROM cells"""


def _observation(type_concept: int) -> str:
    return f"""SELECT fact_id AS observation_id, person_id, concept_id AS observation_concept_id,
  day AS observation_date, {type_concept}::BIGINT AS observation_type_concept_id,
  cell AS observation_source_value, {_nulls("TIMESTAMP", "observation_timestamp")},
  {_nulls("DOUBLE", "value_as_number")},
  {_nulls("BIGINT", "value_as_concept_id", "qualifier_concept_id", "unit_concept_id",
          "provider_id", "visit_occurrence_id", "visit_detail_id",
          "observation_source_concept_id", "observation_event_id",
          "obs_event_field_concept_id")},
  {_nulls("VARCHAR", "value_as_string", "unit_source_value", "qualifier_source_value",
          "value_source_value")}
FROM cells"""


# the columns the adapters have, in the order of the fact tables
# fixed values: source cells and their concepts
BIRTH_CONDITION_CELLS = [
    ("STDNEPIDEM", 432250),
    ("TPAPRESENT", 40338816),
    ("SEMAGESTAC", 40608797),
    ("CODANOMAL", 4079975),
    ("DTULTMENST", 4072438),
    ("GESTACAO", 44789950),
    ("GRAVIDEZ", 1030947),
    ("CONSPRENAT", 4313474),
    ("KOTELCHUCK", 4112701),
    ("TPMETESTIM", 42538440),
]
BIRTH_PROCEDURE_CELLS = [
    ("PARTO", 4264420),
    ("STTRABPART", 4014719),
    ("CONSULTAS", 4313474),
    ("MESPRENAT", 4311447),
    ("STCESPARTO", 4053609),
]
BIRTH_MEASUREMENT_CELLS = [
    ("TPROBSON", 4019758),
    ("APGAR1", 4014304),
    ("APGAR5", 4016464),
    ("PESO", 4264825),
]
BIRTH_OBSERVATION_CELLS = [("PARIDADE", 4060186)]
DEATH_CONDITION_CELLS = [
    ("ATESTADO", 4146323),
    ("CIRCOBITO", 4302017),
    ("CIRURGIA", 4183699),
    ("GESTACAO", 40533858),
    ("GRAVIDEZ", 432969),
    ("OBITOGRAV", 45880429),
    ("OBITOPARTO", 4028785),
    ("OBITOPUERP", 4239459),
    ("SEMAGESTAC", 44789950),
    ("TIPOBITO", 4079844),
]
DEATH_PROCEDURE_CELLS = [
    ("EXAME", 4059372),
    ("LINHAA", 4083743),
    ("LINHAB", 4083743),
    ("LINHAC", 4083743),
    ("LINHAD", 4083743),
    ("LINHAII", 4083743),
    ("NECROPSIA", 37396511),
    ("PARTO", 3955907),
]


def _int(column: str, name: str) -> str:
    return f"TRY_CAST({column} AS INTEGER) AS {name}"


def _day(column: str) -> str:
    return f"try_strptime({column}, '%d%m%Y')"


def _person_extension() -> str:
    ints = {
        "mother_age": "IDADEMAE",
        "mother_city_of_birth": "CODMUNNATU",
        "mother_elementary_school": "SERIESCMAE",
        "father_age": "IDADEPAI",
        "care_site_of_birth_source_value": "CODESTAB",
        "mother_country_of_origin": "NATURALMAE",
        "number_of_dead_children": "QTDFILMORT",
        "number_of_living_children": "QTDFILVIVO",
        "number_of_previous_pregnancies": "QTDGESTANT",
        "number_of_previous_cesareans": "QTDPARTCES",
        "number_of_previous_normal_born": "QTDPARTNOR",
    }
    return (
        _with(*BORN)
        + f"""SELECT person_id, 1 AS system_source_id,
  strftime(event_ts, '%Y-%m-%d') AS datasus_person_source_date,
  strftime({_day("DTNASCMAE")}, '%Y-%m-%d') AS mother_birth_date,
  DTNASCMAE AS mother_birth_date_source_value, ESCMAE AS mother_years_of_study,
  ESCMAE2010 AS mother_education_level, ESCMAEAGR1 AS mother_education_level_aggregated,
  ESTCIVMAE AS mother_marital_status, RACACORMAE AS mother_race,
  LOCNASC AS place_of_birth_type_source_value, CODOCUPMAE AS mother_professional_occupation,
  {", ".join(_int(source, target) for target, source in ints.items())},
  {_nulls("INTEGER", "mother_state_of_birth", "responsible_document_type",
          "responsible_role_type")}
FROM births"""
    )


def _death_extension() -> str:
    ints = {
        "defunct_job_related_death": "ACIDTRAB",
        "death_reason_changed": "ALTCAUSA",
        "defunct_in_continuous_treatment": "ASSISTMED",
        "defunct_city_of_death": "CODMUNOCOR",
        "defunct_age": "IDADE",
        "mother_age": "IDADEMAE",
        "birth_death": "MORTEPARTO",
        "defunct_main_occupation": "OCUP",
        "number_of_dead_children": "QTDFILMORT",
        "number_of_living_children": "QTDFILVIVO",
        "death_occurrence_time": "TPOBITOCOR",
        "type_place_of_death": "LOCOCOR",
    }
    return (
        _with(*DIED)
        + f"""SELECT person_id, 2 AS system_source_id,
  strftime(death_ts, '%Y-%m-%d') AS datasus_person_source_date,
  {_day("DTCADINF")} AS death_investigation_date, ESC AS defunct_years_of_study,
  ESC2010 AS defunct_education_level, ESCMAE AS mother_years_of_study,
  ESTCIV AS defunct_marital_status, OCUPMAE AS mother_professional_occupation,
  TPNIVELINV AS death_investigation_level, TPPOS AS death_investigated,
  {_day("DTCADINV")} AS investigation_register_date,
  {_day("DTCONINV")} AS investigation_conclusion_date, {_day("DTINVESTIG")} AS investigation_date,
  CAUSABAS_O AS death_cause_original, CRM AS physician_id,
  {", ".join(_int(source, target) for target, source in ints.items())},
  {_nulls("TIMESTAMP", "investigation_case_conclusion_date")},
  {_nulls("INTEGER", "defunct_city_of_birth", "autopsy_city", "defunct_elementary_school",
          "mother_elementary_school", "death_additional_info", "investigation_source",
          "death_occurrence_time_2012")},
  {_nulls("VARCHAR", "defunct_education_level_aggregated", "mother_education_level",
          "mother_education_level_aggregated", "information_source", "death_cause_previous")}
FROM deaths"""
    )


def _period(source: str, number: str, day: str, type_concept: int) -> str:
    return f"""SELECT ({number})::BIGINT AS observation_period_id, person_id,
  {day} AS observation_period_start_date, {day} AS observation_period_end_date,
  {type_concept}::BIGINT AS period_type_concept_id FROM {source}"""


def _variables() -> list[str]:
    columns = []
    for name, factor in adapters.CLIMATE_FACTORS.items():
        for statistic, function in [
            ("mean", "avg"),
            ("min", "min"),
            ("max", "max"),
            ("stdev", "stddev_samp"),
            ("sum", "sum"),
        ]:
            if statistic != "sum" or name in ("PR", "ETo"):
                columns.append(f"{function}(value * {factor}) AS {name}_{statistic}")
    return columns


_CODE = f"""{U("user_id % 25")} || lpad((user_id % 25)::VARCHAR, 4, '0')
      || (user_id % 25 % 10)::VARCHAR"""
CLIMATE = f"""climate AS (
  SELECT code_muni, date, {", ".join(_variables())}
  FROM (SELECT {_CODE} AS code_muni, strftime(ts, '%Y-%m-%d') AS date, value FROM events)
  GROUP BY code_muni, date)"""


def _rounded(column: str) -> str:
    return f"round(({column})::FLOAT::DOUBLE, 4)"


# fixed values: names of the climate targets and their sources
_TARGET_VARIABLES = [
    ("temperature_min", "TMIN"),
    ("temperature_max", "TMAX"),
    ("precipitation", "PR"),
    ("relative_humidity", "RH"),
    ("solar_radiaton", "Rs"),
    ("wind_speed", "u2"),
    ("evapotranspiration", "ETo"),
]
_TARGET_POLLUTANTS = [
    ("ethane_c2h6", "c2h6"),
    ("acetone_ch3coch3", "ch3coch3"),
    ("methane_ch4", "ch4"),
    ("carbon_monoxide_co", "co"),
    ("carbon_dioxide_co2s", "co2s"),
    ("hydrogen_chloride_hcl", "hcl"),
    ("max_to_min_concentration_rate_mmrpm10", "mmrpm10"),
    ("max_to_min_concentration_rate_mmrpm2p5", "mmrpm2p5"),
    ("nitrogen_dioxide_no2", "no2"),
    ("maximum_tropospheric_ozone_sfo3max", "sfo3max"),
    ("sulfur_dioxide_so2", "so2"),
]


def _conformed_climate() -> str:
    values = []
    for target, source in _TARGET_VARIABLES:
        for statistic in ("mean", "min", "max", "stdev", "sum"):
            if statistic != "sum" or source in ("PR", "ETo"):
                value = _rounded(f"{source}_{statistic}")
            else:
                value = "NULL::DOUBLE"
            values.append(f"{value} AS {target}_{statistic}_value")
    for target, source in _TARGET_POLLUTANTS:
        factor = adapters.POLLUTANT_FACTORS[source]
        values.append(f"{_rounded(f'TMAX_max * {factor}')} AS {target}")
    return (
        _with(CLIMATE, CITY, STATES)
        + f"""SELECT location_id::BIGINT AS location_id, code_muni AS city_code,
  city AS city_name, substr(code_muni, 1, 2) AS state_code,
  'U' || substr(code_muni, 1, 2) AS state_abbreviation, state_name,
  region_code::DOUBLE AS region_code, region_name, date AS measurement_date,
  {", ".join(values)}
FROM climate LEFT JOIN city ON code_muni = location_source_value
  LEFT JOIN states ON county = states.state_code"""
    )


def _flat_climate() -> str:
    numbers = [column.split(" AS ")[1] for column in _variables()]
    return (
        _with(CLIMATE)
        + f"""SELECT code_muni, 'U' || substr(code_muni, 1, 2) AS abbrev_state,
  substr(code_muni, 1, 2) AS name_state, substr(code_muni, 1, 1) AS code_region,
  'U' || substr(code_muni, 1, 2) AS name_region, date::TIMESTAMP AS date,
  {", ".join(f"round({name}, 9) AS {name}" for name in numbers)},
  day(date::DATE)::VARCHAR AS n_days_TN10p, month(date::DATE)::VARCHAR AS n_days_TX90p,
  year(date::DATE)::VARCHAR AS n_days_TX_gd_35, code_muni || '-' || date AS index_level_0__
FROM climate"""
    )


_BUCKETS = {
    "second": "date_trunc('second', ts)",
    "minute": "date_trunc('minute', ts)",
    "hour": "date_trunc('hour', ts)",
    "day": "date_trunc('day', ts)",
    "week": "date_trunc('week', ts)",
    "month": "date_trunc('month', ts)",
    "quarter": "date_trunc('quarter', ts)",
    "year": "date_trunc('year', ts)",
    "week_ending_saturday": "ts::DATE + (6 - dayofweek(ts))::INTEGER",
    "week_starting_sunday": "ts::DATE - dayofweek(ts)::INTEGER",
}


def _grain(bucket: str) -> str:
    return f"""SELECT ({bucket})::TIMESTAMP AS bucket, count(*) AS events,
  round(sum(value), 2) AS total, max(value) AS highest FROM events GROUP BY 1"""


_SHIPPED = (
    "l_shipdate::DATE::TIMESTAMP AS valid_start_date,"
    " TIMESTAMP '2099-12-31' AS valid_end_date"
)
_VOCABULARY = {
    "concept": "SELECT p_partkey AS concept_id, p_name AS concept_name, p_type AS domain_id,"
    " p_brand AS vocabulary_id, 'Part' AS concept_class_id,"
    " CASE WHEN p_size > 25 THEN 'S' END AS standard_concept, 'C' || p_partkey AS concept_code,"
    " TIMESTAMP '1970-01-01' AS valid_start_date, TIMESTAMP '2099-12-31' AS valid_end_date,"
    " CASE WHEN p_size < 5 THEN 'D' END AS invalid_reason FROM part",
    "concept_class": "SELECT p_type AS concept_class_id, 'Class ' || p_type AS concept_class_name,"
    " min(p_partkey) AS concept_class_concept_id FROM part GROUP BY p_type",
    "concept_synonym": "SELECT p_partkey AS concept_id,"
    " p_brand || ' ' || p_name AS concept_synonym_name,"
    " 4180186::BIGINT AS language_concept_id FROM part",
    "drug_strength": "SELECT l_partkey AS drug_concept_id, l_suppkey AS ingredient_concept_id,"
    " round(l_quantity::FLOAT::DOUBLE, 4) AS amount_value, 8576::BIGINT AS amount_unit_concept_id,"
    " CASE WHEN l_linenumber > 3 THEN round(l_discount::FLOAT::DOUBLE, 4) END AS numerator_value,"
    " CASE WHEN l_linenumber > 3 THEN 8576::BIGINT END AS numerator_unit_concept_id,"
    " round(l_tax::FLOAT::DOUBLE, 4) AS denominator_value,"
    " 8587::BIGINT AS denominator_unit_concept_id,"
    f" l_linenumber AS box_size, {_SHIPPED}, NULL::VARCHAR AS invalid_reason FROM lineitem",
    "vocabulary": "SELECT p_brand AS vocabulary_id, 'Vocabulary ' || p_brand AS vocabulary_name,"
    " NULL::VARCHAR AS vocabulary_reference, 'v' || max(p_size) AS vocabulary_version,"
    " min(p_partkey) AS vocabulary_concept_id FROM part GROUP BY p_brand",
    "concept_ancestor": "SELECT l_partkey AS ancestor_concept_id,"
    " l_suppkey AS descendant_concept_id, l_linenumber AS min_levels_of_separation,"
    " l_linenumber + 1 AS max_levels_of_separation FROM lineitem",
    "concept_relationship": "SELECT l_partkey AS concept_id_1, l_suppkey AS concept_id_2,"
    f" 'Maps to ' || l_returnflag AS relationship_id, {_SHIPPED},"
    " CASE WHEN l_linestatus = 'F' THEN 'D' END AS invalid_reason FROM lineitem",
    "domain": "SELECT o_orderpriority AS domain_id, 'Domain ' || o_orderpriority AS domain_name,"
    " min(o_orderkey) AS domain_concept_id FROM orders GROUP BY o_orderpriority",
    "relationship": "SELECT l_returnflag || l_linestatus AS relationship_id,"
    " 'From ' || l_returnflag || ' to ' || l_linestatus AS relationship_name,"
    " '0' AS is_hierarchical, '1' AS defines_ancestry,"
    " l_linestatus || l_returnflag AS reverse_relationship_id,"
    " count(*) AS relationship_concept_id FROM lineitem GROUP BY l_returnflag, l_linestatus",
}

_COUNTRY = "4075645::BIGINT AS country_concept_id, 'Brasil' AS country_source_value"
_SUPPLIER_CODE = "lpad(s_suppkey::VARCHAR, 7, '0')"
_SUPPLIER_RANK = f"row_number() OVER (ORDER BY {_SUPPLIER_CODE})"


def _load(
    source: str, event: str, records: tuple[str, ...], tables: dict[str, int], without_day: int = 0
) -> str:
    """Rows per table; the last ``without_day`` tables have no column with the day of the event."""
    dated = len(tables) - without_day
    rows = "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, n * {width} AS rows, n * {width} AS distinct_keys, "
        f"n * {width if i < dated else 0} AS of_their_day, (days * {width})::BIGINT AS days FROM c"
        for i, (table, width) in enumerate(tables.items())
    )
    counted = (
        f"c AS (SELECT count(*)::BIGINT AS n, sum(date_diff('day', DATE '1970-01-01', "
        f"{event}::DATE)) AS days FROM {source})"
    )
    return _with(*records, counted) + rows


def statements() -> dict[str, str]:
    """SQL per query name."""
    born, died = _with(*BORN), _with(*DIED)
    sql = {
        "mortality_rates": _mortality(),
        "mortality_rates_of_model": _mortality(),
        "mortality_rates_of_store": _mortality(),
        "births_by_state": _with(*BORN, CITY, BIRTHS_BY_STATE) + "SELECT * FROM births_by_state",
        "deaths_by_age_band": _with(*DIED, CITY, DEATHS_BY_STATE)
        + "SELECT * FROM deaths_by_state",
        "clean_births": _with(RAW_BIRTHS, CLEAN_BIRTHS)
        + "SELECT rec_id, DTNASC, HORANASC, event_ts FROM clean_births",
        "clean_deaths": _with(PLACED_DEATHS, CLEAN_DEATHS)
        + f"""SELECT {", ".join(adapters.DEATH_KEY)} , DTOBITO, HORAOBITO, death_ts, birth_ts
FROM clean_deaths""",
        "rejected_births": _with(RAW_BIRTHS, CLEAN_BIRTHS)
        + """SELECT rec_id, DTNASC, 'event_ts' AS missing_columns FROM clean_births
WHERE event_ts IS NULL""",
        "person_births": _with(RAW_BIRTHS, CLEAN_BIRTHS, DENSE_BIRTHS, CITY)
        + _person(
            "births",
            "year(event_ts)::INTEGER",
            "month(event_ts)::INTEGER",
            "day(event_ts)::INTEGER",
            "event_ts",
        ),
        "person_deaths": _with(PLACED_DEATHS, CLEAN_DEATHS, DENSE_DEATHS, CITY)
        + _person(
            "deaths",
            "coalesce(year(birth_ts), 0)::INTEGER",
            "NULL::INTEGER",
            "NULL::INTEGER",
            "birth_ts",
        ),
        "obs_period_births": born + _period("births", "person_id", "event_ts", 4193440),
        "obs_period_deaths": died
        + _period(
            "deaths",
            "person_id * 2 - 1",
            f"coalesce({_day('DTATESTADO')}, {_day('DTOBITO')})",
            4306655,
        )
        + "\nUNION ALL "
        + _period(
            "deaths",
            "person_id * 2",
            f"coalesce({_day('DTCADASTRO')}, {_day('DTOBITO')})",
            4306655,
        ),
        "person_extension": _person_extension(),
        "death_extension": _death_extension(),
        "death_records": died
        + f"""SELECT person_id, death_ts AS death_date, death_ts AS death_timestamp,
  4306655::BIGINT AS death_type_concept_id, CAUSABAS AS cause_source_value,
  {_nulls("BIGINT", "cause_concept_id", "cause_source_concept_id")} FROM deaths""",
        "contract_violations": _with(RAW_BIRTHS, CLEAN_BIRTHS)
        + """, n AS (SELECT count(*) AS rows_checked, count(*) FILTER (event_ts IS NULL) AS bad
  FROM clean_births)
SELECT rows_checked, column_name, CASE WHEN dated THEN bad ELSE 0 END AS null_rows
FROM n, (VALUES ('observation_period_id', false), ('person_id', false),
  ('observation_period_start_date', true), ('observation_period_end_date', true),
  ('period_type_concept_id', false)) AS t(column_name, dated)""",
        "surrogate_keys": """SELECT row_number() OVER (ORDER BY o_orderkey) AS order_id,
  o_orderkey, o_custkey FROM orders""",
        "position_keys": """SELECT count(*) AS rows, count(*) AS distinct_keys,
  1::BIGINT AS lowest, count(*) AS highest FROM lineitem""",
        "append_only_new": """SELECT year(o_orderdate)::INTEGER AS order_year, count(*) AS rows,
  round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""",
        "dim_city": f"""WITH raw AS (
  SELECT n_name, {U("n_nationkey")} || lpad(n_nationkey::VARCHAR, 4, '0')
      || (n_nationkey % 10)::VARCHAR AS code,
    '-' || n_nationkey || '.' || lpad((n_nationkey * 2)::VARCHAR, 2, '0') AS lat,
    '-' || (40 + n_nationkey) || '.' || lpad((n_nationkey * 3)::VARCHAR, 2, '0') AS lon
  FROM nation), {STATES}
SELECT row_number() OVER (ORDER BY code) AS location_id, n_name AS city, state_name AS state,
  state_code AS county, code AS location_source_value, {_COUNTRY},
  {_rounded("lat")} AS latitude, {_rounded("lon")} AS longitude,
  {_nulls("VARCHAR", "address_1", "address_2", "zip")}
FROM raw JOIN states ON substr(code, 1, 2) = state_code""",
        "dim_facility": f"""SELECT 100 + {_SUPPLIER_RANK} AS location_id,
  concat_ws(' ', 'RUA ' || s_suppkey, (s_suppkey % 1000)::VARCHAR,
    CASE WHEN s_suppkey % 3 <> 0 THEN 'SALA ' || (s_suppkey % 50) END) AS address_1,
  'BAIRRO ' || (s_suppkey % 20) AS address_2,
  {U("s_nationkey")} || lpad(s_nationkey::VARCHAR, 4, '0') AS city,
  {U("s_nationkey")} AS state, lpad((s_suppkey % 99999999)::VARCHAR, 8, '0') AS zip,
  NULL::VARCHAR AS county, {_SUPPLIER_CODE} AS location_source_value, {_COUNTRY},
  CASE WHEN s_suppkey % 4 <> 0 THEN -(s_suppkey % 30 + 0.5)::DOUBLE END AS latitude,
  -(s_suppkey % 60 + 0.25)::DOUBLE AS longitude
FROM supplier""",
        "dim_care_site": f"""SELECT 4 + {_SUPPLIER_RANK} AS care_site_id, s_name AS care_site_name,
  100 + {_SUPPLIER_RANK} AS location_id, {_SUPPLIER_CODE} AS care_site_source_value,
  {_nulls("BIGINT", "place_of_service_concept_id")},
  {_nulls("VARCHAR", "place_of_service_source_value")} FROM supplier""",
        "dim_provider": f"""WITH held AS (
  SELECT s_suppkey + 3 AS provider_id, s_name AS provider_name, NULL::BIGINT AS concept,
    NULL::VARCHAR AS label, NULL::BIGINT AS code FROM supplier),
fixed (provider_id, provider_name, concept, label, code) AS (VALUES
  (1::BIGINT, NULL::VARCHAR, 4206451::BIGINT, 'Médico', 1::BIGINT),
  (2, NULL, 32581, 'Enfermeira/obstetriz', 2), (3, NULL, 40561317, 'Parteira', 3),
  (4, NULL, 3245354, 'Outros', 4), (5, NULL, 3400510, 'Ignorado', 9))
SELECT provider_id, provider_name, concept AS specialty_concept_id,
  label AS specialty_source_value, code AS specialty_source_concept_id,
  {_nulls("VARCHAR", "npi", "dea", "provider_source_value", "gender_source_value")},
  {_nulls("BIGINT", "care_site_id", "gender_concept_id", "gender_source_concept_id")},
  {_nulls("INTEGER", "year_of_birth")}
FROM (SELECT * FROM held UNION ALL
  SELECT * FROM fixed WHERE provider_id NOT IN (SELECT provider_id FROM held))""",
        "dim_rowkind": f"""SELECT 'city' AS kind, {U("n_nationkey")} AS state, count(*) AS rows
FROM nation GROUP BY 2
UNION ALL SELECT 'facility', {U("s_nationkey")}, count(*) FROM supplier GROUP BY 2""",
        "climate_daily": _with(CLIMATE)
        + "SELECT code_muni, date, "
        + ", ".join(
            f"round({c.split(' AS ')[1]}, 9) AS {c.split(' AS ')[1]}" for c in _variables()
        )
        + " FROM climate",
        "climate_conformed": _conformed_climate(),
        "climate_flat": _flat_climate(),
        "climate_percentiles": _with(CLIMATE)
        + f"""SELECT code_muni AS city_code,
  {_rounded("quantile_disc(TMAX_mean, 0.9)")} AS tx_90p,
  {_rounded("quantile_disc(TMIN_mean, 0.1)")} AS tn_10p FROM climate GROUP BY 1""",
        "time_filter": """SELECT event_type, count(*) AS events, min(ts) AS first_ts FROM events
WHERE ts >= TIMESTAMP '2024-01-08 06:00:00' AND ts < TIMESTAMP '2024-01-22 18:30:00'
GROUP BY event_type""",
        "latest_partition": """SELECT event_id, ts, user_id, event_type, round(value, 4) AS value,
  props, strftime(ts, '%Y-%m-%d') AS day FROM events
WHERE ts::DATE = (SELECT max(ts::DATE) FROM events)""",
        "browse_sample": """SELECT o_orderkey, o_custkey, o_orderstatus,
  round(o_totalprice, 4) AS o_totalprice, o_orderdate, o_orderpriority
FROM orders ORDER BY orders.o_totalprice DESC, o_orderkey LIMIT 100""",
        "code_to_concept": """SELECT l_orderkey, l_linenumber,
  'C' || (l_partkey // 10) || '.' || (l_partkey % 10) AS source_code, concept_id
FROM lineitem LEFT JOIN (
  SELECT 'C' || p_partkey AS code, min(p_partkey) AS concept_id FROM part
  WHERE p_brand = 'Brand#2' GROUP BY 1) ON 'C' || (l_partkey // 10) || (l_partkey % 10) = code""",
        "folder_ingest": f"""SELECT year(o_orderdate)::INTEGER AS file_year, count(*) AS rows,
  count(*) FILTER (year(o_orderdate) >= {YEAR} AND o_orderpriority IS NOT NULL) AS with_priority,
  count(*) AS in_their_file, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""",
        "births_load": _load(
            "births",
            "event_ts",
            BORN,
            {
                "person": 1,
                "observation_period": 1,
                "condition_occurrence": 10,
                "procedure_occurrence": 5,
                "measurement": 4,
                "observation": 1,
                "datasus_person": 1,
            },
        ),
        "deaths_load": _load(
            "deaths",
            "death_ts",
            DIED,
            {
                "condition_occurrence": 10,
                "procedure_occurrence": 8,
                "measurement": 1,
                "death": 1,
                "datasus_death": 1,
                "person": 1,
                "observation_period": 2,
            },
            without_day=2,
        ),
        "latest_table_partition": """WITH e AS (SELECT event_id,
    CASE WHEN event_id % 50 <> 0 THEN date_trunc('day', ts)::TIMESTAMP END AS day,
    CASE WHEN event_id % 7 <> 0 THEN event_type || ':1/a' END AS kind FROM events)
SELECT * FROM e WHERE (day, kind) = (SELECT (day, kind) FROM e
  WHERE day IS NOT NULL AND kind IS NOT NULL ORDER BY day DESC, kind DESC LIMIT 1)""",
        "facilities_load": f"""SELECT {_SUPPLIER_CODE} AS care_site_source_value,
  s_name AS care_site_name, concat_ws(' ', 'RUA ' || s_suppkey, (s_suppkey % 1000)::VARCHAR,
    CASE WHEN s_suppkey % 3 <> 0 THEN 'SALA ' || (s_suppkey % 50) END) AS address_1,
  {U("s_nationkey")} || lpad(s_nationkey::VARCHAR, 4, '0') AS city FROM supplier""",
        "cities_load": f"""WITH raw AS (SELECT {U("n_nationkey")}
    || lpad(n_nationkey::VARCHAR, 4, '0') || (n_nationkey % 10)::VARCHAR AS code FROM nation)
SELECT 'loaded' AS outcome, code FROM raw
UNION ALL SELECT 'rejected', '99' || substr(code, 3, 5) FROM raw""",
        "climate_load": _with(CLIMATE, CITY)
        + """SELECT code_muni AS city_code, city AS city_name, date AS day
FROM climate LEFT JOIN city ON code_muni = location_source_value
UNION ALL SELECT DISTINCT NULL::VARCHAR, NULL::VARCHAR, date FROM climate""",
        "climate_flat_load": _with(CLIMATE)
        + """SELECT code_muni, date::TIMESTAMP AS day FROM climate
UNION ALL SELECT DISTINCT NULL::VARCHAR, date::TIMESTAMP FROM climate""",
        "climate_years_load": _with(CLIMATE)
        + """SELECT (2024 + later)::INT AS year, count(*) + count(DISTINCT date) AS rows,
  count(*) AS city_days, count(DISTINCT date) AS days
FROM climate, range(3) AS r(later) GROUP BY later""",
        "vocabulary_load": """SELECT 'concept' AS table_name, count(*) AS rows FROM part
UNION ALL SELECT 'rejected', count(*) FROM part
UNION ALL SELECT 'concept_class', count(DISTINCT p_type) FROM part
UNION ALL SELECT 'concept_synonym', count(*) FROM part
UNION ALL SELECT 'vocabulary', count(DISTINCT p_brand) FROM part
UNION ALL SELECT 'domain', count(DISTINCT o_orderpriority) FROM orders
UNION ALL SELECT 'relationship', count(DISTINCT (l_returnflag, l_linestatus)) FROM lineitem
UNION ALL SELECT 'drug_strength', count(DISTINCT (l_partkey, l_suppkey, l_shipdate)) FROM lineitem
UNION ALL SELECT 'concept_ancestor', count(DISTINCT (l_partkey, l_suppkey)) FROM lineitem
UNION ALL SELECT 'concept_relationship', count(DISTINCT (l_partkey, l_suppkey, l_returnflag))
FROM lineitem""",
        "ddl_script": """SELECT 'a' AS name, 'x;--y' AS t, count(*) AS rows,
  sum(o_orderkey)::BIGINT AS total FROM orders
UNION ALL SELECT 'b', 'x;--y', count(*), sum(o_orderkey)::BIGINT FROM orders
WHERE o_orderkey % 2 = 0""",
        "publish_table": _with(*BORN, CITY, BIRTHS_BY_STATE) + "SELECT * FROM births_by_state",
    }
    label1, ordinal1 = _band("rate", "<=", "11,1 - 13,1")
    label5, ordinal5 = _band("rate", "<", "11,1 - 13,0")
    sql["rate_bands"] = f"""SELECT *, {label1} AS infant_label, {ordinal1} AS infant_ordinal,
  {label5} AS under_five_label, {ordinal5} AS under_five_ordinal
FROM (SELECT l_orderkey, l_linenumber,
  round(l_quantity * 1000 / (1900 + l_linenumber * 50), 2) AS rate FROM lineitem)"""
    for name, cells, build, concept in [
        ("facts_condition", BIRTH_CONDITION_CELLS, _condition, 4216316),
        ("facts_procedure", BIRTH_PROCEDURE_CELLS, _procedure, 4216316),
        ("facts_measurement", BIRTH_MEASUREMENT_CELLS, _measurement, 4216316),
        ("facts_observation", BIRTH_OBSERVATION_CELLS, _observation, 4216316),
    ]:
        sql[name] = _with(*BORN, _cell_rows("births", "event_ts", cells)) + build(concept)
    for name, cells, build in [
        ("death_facts_condition", DEATH_CONDITION_CELLS, _condition),
        ("death_facts_procedure", DEATH_PROCEDURE_CELLS, _procedure),
        ("death_facts_measurement", [("PESO", 4264825)], _measurement),
    ]:
        sql[name] = _with(*DIED, _cell_rows("deaths", "death_ts", cells, True)) + build(4306655)
    for grain, bucket in _BUCKETS.items():
        sql[f"time_grain_{grain}"] = _grain(bucket)
    for table, text in _VOCABULARY.items():
        sql[f"vocab_{table}"] = text
    return sql
