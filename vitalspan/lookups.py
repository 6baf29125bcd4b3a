"""Fixed reference relations and code lists.

Every value in this file is a fixed value: the outputs are only right if they are as they stand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# federative units: name, code, abbreviation, region code, region name
STATES = [
    ("Acre", 12, "AC", 1, "Norte"),
    ("Alagoas", 27, "AL", 2, "Nordeste"),
    ("Amapá", 16, "AP", 1, "Norte"),
    ("Amazonas", 13, "AM", 1, "Norte"),
    ("Bahia", 29, "BA", 2, "Nordeste"),
    ("Ceará", 23, "CE", 2, "Nordeste"),
    ("Distrito Federal", 53, "DF", 5, "Centro-Oeste"),
    ("Espírito Santo", 32, "ES", 3, "Sudeste"),
    ("Goiás", 52, "GO", 5, "Centro-Oeste"),
    ("Maranhão", 21, "MA", 2, "Nordeste"),
    ("Mato Grosso", 51, "MT", 5, "Centro-Oeste"),
    ("Mato Grosso do Sul", 50, "MS", 5, "Centro-Oeste"),
    ("Minas Gerais", 31, "MG", 3, "Sudeste"),
    ("Pará", 15, "PA", 1, "Norte"),
    ("Paraíba", 25, "PB", 2, "Nordeste"),
    ("Paraná", 41, "PR", 4, "Sul"),
    ("Pernambuco", 26, "PE", 2, "Nordeste"),
    ("Piauí", 22, "PI", 2, "Nordeste"),
    ("Rio Grande do Norte", 24, "RN", 2, "Nordeste"),
    ("Rio Grande do Sul", 43, "RS", 4, "Sul"),
    ("Rio de Janeiro", 33, "RJ", 3, "Sudeste"),
    ("Rondônia", 11, "RO", 1, "Norte"),
    ("Roraima", 14, "RR", 1, "Norte"),
    ("Santa Catarina", 42, "SC", 4, "Sul"),
    ("São Paulo", 35, "SP", 3, "Sudeste"),
    ("Sergipe", 28, "SE", 2, "Nordeste"),
    ("Tocantins", 17, "TO", 1, "Norte"),
]
UNKNOWN_STATE = "Desconhecido"
ISO_COUNTRY = "BR"

# birth attendants: provider id, specialty concept, label, source code
PROVIDERS = [
    (1, 4206451, "Médico", 1),
    (2, 32581, "Enfermeira/obstetriz", 2),
    (3, 40561317, "Parteira", 3),
    (4, 3245354, "Outros", 4),
    (5, 3400510, "Ignorado", 9),
]

# births outside a facility: care site id, name, place concept, source code, place label
SEED_CARE_SITES = [
    (3, "Nascimento no Domicílio", 43021744, "3", "Domicílio"),
    (4, "Nascimento em Outros Locais", 45881550, "4", "Outros"),
]

# code lists: concept -> source spellings
GENDER_CONCEPTS = {8507: ("M", "1", "Masculino"), 8532: ("F", "2", "Feminino")}
GENDER_UNKNOWN = 8551
RACE_CONCEPTS = {
    3212942: ("1", "Branca"),
    3213733: ("2", "Preta"),
    3213498: ("3", "Amarela"),
    3213487: ("4", "Parda"),
    3213694: ("5", "Indígena"),
}
RACE_UNKNOWN = 763013
NULL_LABEL = "Nulo"
ETHNICITY_CONCEPT = 38003563
COUNTRY_CONCEPT = 4075645
COUNTRY_NAME = "Brasil"

# provenance of births and deaths: type concept, source system number
BIRTH_TYPE_CONCEPT = 4216316
BIRTH_PERIOD_CONCEPT = 4193440
BIRTH_SYSTEM = 1
DEATH_TYPE_CONCEPT = 4306655
DEATH_SYSTEM = 2


def _relation(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Fixed rows as a literal relation, whose size the optimizer knows."""
    columns = [column.split() for column in schema.split(", ")]

    def literal(value: object) -> str:
        return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    names = ", ".join(name for name, _ in columns)
    typed = ", ".join(f"CAST({name} AS {type_name}) AS {name}" for name, type_name in columns)
    return spark.sql(f"SELECT {typed} FROM VALUES {values} AS fixed({names})")


def states(spark: SparkSession) -> DataFrame:
    """The 27 federative units, with the code as text (the form it has in every other table)."""
    return _relation(
        spark,
        STATES,
        "state_name string, state_code string, state_abbreviation string, region_code int,"
        " region_name string",
    )


def providers(spark: SparkSession) -> DataFrame:
    """Kinds of birth attendants."""
    return _relation(spark, PROVIDERS, "id bigint, concept bigint, label string, code bigint")


def seed_care_sites(spark: SparkSession) -> DataFrame:
    """Births outside a facility."""
    return _relation(
        spark,
        SEED_CARE_SITES,
        "id bigint, name string, concept bigint, code string, place string",
    )
