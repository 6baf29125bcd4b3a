"""Projections of the test tables into the shape of the real inputs.

The text of births and deaths is shared with the DuckDB side; only the functions named in
``Dialect`` differ. All three tables grow with the data, so none of them is broadcast (DuckDB
reads the hint as a comment). Every row of ``orders`` is a birth, every row of ``lineitem`` a
death. Some values are bad on purpose: missing and impossible dates, odd clock times, several
spellings.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalspan.plans.climate import daily_statistics
from vitalspan.sources.files import read_parquet, with_lineage

# fixed values: state codes of nation 0, 1, 2, ...
STATE_CODES = [
    "11", "12", "13", "14", "15", "16", "17", "21", "22", "23", "24", "25", "26", "27", "28", "29",
    "31", "32", "33", "35", "41", "42", "43", "50", "51",
]
# as SQL looks them up, two digits each
NATION_STATES = "".join(STATE_CODES)


class Dialect(NamedTuple):
    """The functions that Spark and DuckDB spell differently."""

    digits: str
    later: str
    orders: str
    lineitem: str
    customer: str
    deaths: str  # where deaths come from, and the hint of its joins
    merged: str
    lineage: str  # columns that tell the position of a record in its file

    def date(self, day: str) -> str:
        return self.digits.format(x=day)

    def add(self, day: str, days: str) -> str:
        return self.later.format(x=day, n=days)


SPARK = Dialect(
    "date_format({x}, 'ddMMyyyy')",
    "date_add(cast({x} as date), cast({n} as int))",
    "{orders}",
    "{lineitem}",
    "{customer}",
    # line items are moved once, to orders that have their customers
    "{lineitem} r join ({orders} o join {customer} c on o.o_custkey = c.c_custkey)"
    " on r.l_orderkey = o.o_orderkey",
    "r, c",
    ", r.source_file, r.source_row",
)
DUCKDB = Dialect(
    "strftime({x}, '%d%m%Y')",
    "(cast({x} as date) + cast({n} as integer))",
    "placed_orders",
    "placed_lineitem",
    "customer",
    """placed_lineitem r join placed_orders o on r.l_orderkey = o.o_orderkey
      join customer c on o.o_custkey = c.c_custkey""",
    "o, c",
    ", r.position",
)


def _text(number: str, width: int = 0) -> str:
    text = f"cast({number} as varchar(20))"
    return f"lpad({text}, {width}, '0')" if width else text


def state_of(nation: str) -> str:
    return f"substr('{NATION_STATES}', cast({nation} as int) * 2 + 1, 2)"


def _city_of(nation: str) -> str:
    return f"{state_of(nation)} || {_text(nation, 4)}"


def births_sql(d: Dialect) -> str:
    k = "r.o_orderkey"
    day = "r.o_orderdate"
    return f"""
    select /*+ merge(c) */ {k} as rec_id{d.lineage},
      case when {k} % 97 = 0 then null when {k} % 101 = 0 then '32132010'
           when {k} % 103 = 0 then '7051998' else {d.date(day)} end as DTNASC,
      case {k} % 5 when 0 then null when 1 then '2575' when 2 then '9H30' when 3 then '915'
           else {_text(f"({k} * 7) % 24", 2)} || {_text(f"({k} * 11) % 60", 2)} end as HORANASC,
      case r.o_custkey % 7 when 0 then 'M' when 1 then 'F' when 2 then '1' when 3 then '2'
           when 4 then 'Masculino' when 5 then 'Feminino' else 'I' end as SEXO,
      case {k} % 8 when 0 then null when 1 then '1' when 2 then '2' when 3 then '3' when 4 then '4'
           when 5 then '5' when 6 then 'Parda' else '9' end as RACACOR,
      {_city_of("c.c_nationkey")} as CODMUNRES,
      {_text("r.o_custkey % 130")} as CODESTAB,
      {_text(f"500 + {k} % 4500")} as PESO,
      case when {k} % 13 = 0 then 'x' else {_text(f"{k} % 11", 2)} end as APGAR1,
      {_text(f"{k} % 10", 2)} as APGAR5,
      {_text(f"1 + {k} % 6")} as GESTACAO,
      {_text(f"1 + {k} % 3")} as GRAVIDEZ,
      {_text(f"1 + {k} % 2")} as PARTO,
      {_text(f"1 + {k} % 4")} as CONSULTAS,
      {_text(f"{k} % 2")} as STDNEPIDEM,
      case when {k} % 10 = 0 then '9' else {_text(f"1 + {k} % 3")} end as TPAPRESENT,
      {_text(f"22 + {k} % 21", 2)} as SEMAGESTAC,
      case when {k} % 5 = 0 then 'Q' || {_text(f"{k} % 100", 2)} || '.' || {_text(f"{k} % 10")}
           else null end as CODANOMAL,
      case when {k} % 9 = 0 then null else {d.date(d.add(day, "-280"))} end as DTULTMENST,
      {_text(f"1 + {k} % 2")} as TPMETESTIM,
      {_text(f"{k} % 15", 2)} as CONSPRENAT,
      {_text(f"1 + {k} % 6")} as KOTELCHUCK,
      {_text(f"1 + {k} % 3")} as STTRABPART,
      {_text(f"1 + {k} % 9", 2)} as MESPRENAT,
      {_text(f"1 + {k} % 3")} as STCESPARTO,
      {_text(f"1 + {k} % 10", 2)} as TPROBSON,
      {_text(f"{k} % 2")} as PARIDADE,
      case when {k} % 7 = 0 then null when {k} % 11 = 0 then '31021980'
           else {d.date(d.add(day, f"-(6570 + {k} % 9000)"))} end as DTNASCMAE,
      {_text(f"1 + {k} % 5")} as ESCMAE,
      {_text(f"1 + {k} % 5")} as ESTCIVMAE,
      case when {k} % 29 = 0 then 'XX' else {_text(f"15 + {k} % 30")} end as IDADEMAE,
      {_city_of("c.c_nationkey")} as CODMUNNATU,
      {_text(f"1 + {k} % 5")} as RACACORMAE,
      {_text(f"1 + {k} % 8")} as SERIESCMAE,
      case when {k} % 3 = 0 then null else {_text(f"18 + {k} % 40")} end as IDADEPAI,
      {_text(f"1 + {k} % 4")} as LOCNASC,
      {_text(f"{k} % 999999", 6)} as CODOCUPMAE,
      '8' || {_text(f"{k} % 100", 2)} as NATURALMAE,
      {_text(f"{k} % 3", 2)} as QTDFILMORT,
      {_text(f"{k} % 7", 2)} as QTDFILVIVO,
      {_text(f"{k} % 9", 2)} as QTDGESTANT,
      {_text(f"{k} % 4", 2)} as QTDPARTCES,
      {_text(f"{k} % 5", 2)} as QTDPARTNOR,
      {_text(f"{k} % 6")} as ESCMAE2010,
      {_text(f"{k} % 13", 2)} as ESCMAEAGR1
    from {d.orders} r join {d.customer} c on r.o_custkey = c.c_custkey
    """


# what tells one line item from another; rows equal in all of it are the same to every query
DEATH_KEY = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_shipdate",
]


def deaths_sql(d: Dialect) -> str:
    k, p, s = "r.l_orderkey", "r.l_partkey", "r.l_suppkey"
    spread = f"({k} * 7919 + r.l_linenumber * 104729 + {p} * 31) % 90000"
    death_day = d.add("r.l_shipdate", spread)
    return f"""
    select /*+ merge({d.merged}) */ {", ".join("r." + column for column in DEATH_KEY)}{d.lineage},
      {d.date("o.o_orderdate")} as DTNASC,
      case when {p} % 89 = 0 then null when {p} % 97 = 0 then '32132010'
           when {p} % 101 = 0 then '7051998' else {d.date(death_day)} end as DTOBITO,
      case when {k} % 4 = 0 then null else {d.date("r.l_shipdate")} end as DTCADASTRO,
      case {k} % 3 when 0 then null when 1 then '99999999'
           else {d.date("r.l_shipdate")} end as DTATESTADO,
      case when {k} % 6 = 0 then null when {k} % 6 = 1 then '2460'
           else {_text(f"{k} % 24", 2)} || '30' end as HORAOBITO,
      case {p} % 3 when 0 then 'M' when 1 then '2' else '0' end as SEXO,
      case {s} % 7 when 0 then null when 1 then '1' when 2 then '2' when 3 then '3'
           when 4 then '4' when 5 then '5' else 'Indígena' end as RACACOR,
      {_city_of("c.c_nationkey")} as CODMUNRES,
      {_text(f"{s} % 130")} as CODESTAB,
      'I' || {_text(f"{p} % 100", 2)} as CAUSABAS,
      'R' || {_text(f"{s} % 100", 2)} as LINHAA,
      case when {k} % 2 = 0 then null else 'J18' end as LINHAB,
      case when {k} % 3 = 0 then null else 'A41' end as LINHAC,
      case when {k} % 5 = 0 then 'P' || {_text(f"{p} % 100", 2)} else null end as LINHAD,
      case when {k} % 7 = 0 then 'E' || {_text(f"{s} % 100", 2)} else null end as LINHAII,
      {_text(f"1 + {k} % 2")} as EXAME,
      {_text(f"1 + {p} % 2")} as NECROPSIA,
      {_text(f"1 + {p} % 2")} as PARTO,
      {_text(f"1 + {s} % 4")} as CIRCOBITO,
      {_text(f"1 + {s} % 2")} as CIRURGIA,
      {_text(f"1 + {k} % 6")} as GESTACAO,
      {_text(f"1 + {k} % 3")} as GRAVIDEZ,
      {_text(f"1 + {p} % 2")} as OBITOGRAV,
      {_text(f"1 + {p} % 3")} as OBITOPARTO,
      {_text(f"1 + {s} % 3")} as OBITOPUERP,
      {_text(f"1 + {k} % 2")} as TIPOBITO,
      {_text(f"1 + {s} % 5")} as ATESTADO,
      {_text(f"22 + {k} % 21", 2)} as SEMAGESTAC,
      case when {p} % 13 = 0 then 'x' else {_text(f"500 + {p} % 4500")} end as PESO,
      {_text(f"{k} % 3")} as ACIDTRAB,
      {_text(f"1 + {k} % 2")} as ASSISTMED,
      {_city_of("c.c_nationkey")} as CODMUNOCOR,
      case when {k} % 8 = 0 then '00000000' else {d.date("r.l_shipdate")} end as DTCADINF,
      {_text(f"1 + {k} % 5")} as ESC,
      {_text(f"1 + {p} % 5")} as ESCMAE,
      {_text(f"1 + {s} % 5")} as ESTCIV,
      {_text(f"400 + {k} % 100")} as IDADE,
      case when {k} % 29 = 0 then 'XX' else {_text(f"15 + {k} % 30")} end as IDADEMAE,
      {_text(f"1 + {k} % 3")} as MORTEPARTO,
      {_text(f"{p} % 999999", 6)} as OCUP,
      {_text(f"{s} % 999999", 6)} as OCUPMAE,
      {_text(f"{k} % 3", 2)} as QTDFILMORT,
      {_text(f"{k} % 7", 2)} as QTDFILVIVO,
      {_text(f"1 + {k} % 9")} as TPOBITOCOR,
      case when {k} % 2 = 0 then 'S' else 'N' end as TPPOS,
      {d.date("r.l_shipdate")} as DTCADINV,
      case when {k} % 9 = 0 then null else {d.date("r.l_shipdate")} end as DTINVESTIG,
      {_text(f"1 + {k} % 5")} as LOCOCOR,
      {_text(f"1 + {k} % 2")} as ALTCAUSA,
      {_text(f"{k} % 6")} as ESC2010,
      case {k} % 3 when 0 then 'E' when 1 then 'R' else 'M' end as TPNIVELINV,
      {d.date("r.l_shipdate")} as DTCONINV,
      'I' || {_text(f"{s} % 100", 2)} as CAUSABAS_O,
      {_text(f"{s} % 99999")} as CRM
    from {d.deaths}
    """


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def births(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Birth records, one per order."""
    return spark.sql(
        births_sql(SPARK),
        orders=with_lineage(table(spark, sf_dir, "orders")),
        customer=table(spark, sf_dir, "customer"),
    )


def deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Death records, one per line item."""
    return spark.sql(
        deaths_sql(SPARK),
        lineitem=with_lineage(table(spark, sf_dir, "lineitem")),
        orders=table(spark, sf_dir, "orders"),
        customer=table(spark, sf_dir, "customer"),
    )


def city_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A municipality per nation; the first six digits of its code are those of the records."""
    code = f"{_city_of('n_nationkey')} || {_text('n_nationkey % 10')}"
    return table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey + 1 as bigint) as location_id",
        "n_name as city",
        f"{state_of('n_nationkey')} as county",
        f"{code} as location_source_value",
    )


def care_site_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A care site per supplier."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as care_site_id",
        "s_name as care_site_name",
        "cast(s_suppkey as string) as care_site_source_value",
    )


CITY_FILE = f"""
    select cast(n_nationkey as varchar(20)) as OID_, n_name as nome,
      {_city_of("n_nationkey")} || {_text("n_nationkey % 10")} as geocodigo,
      '-' || {_text("40 + n_nationkey")} || ',' || {_text("n_nationkey * 3", 2)} as Longitude,
      '-' || {_text("n_nationkey")} || ',' || {_text("n_nationkey * 2", 2)} as Latitude
    from {{nation}}
"""

FACILITY_COLUMNS = [
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
]
FACILITY_FILE = f"""
    select {_text("s_suppkey", 7)} as CO_CNES, s_name as NO_RAZAO_SOCIAL,
      'RUA ' || {_text("s_suppkey")} as NO_LOGRADOURO, {_text("s_suppkey % 1000")} as NU_ENDERECO,
      case when s_suppkey % 3 = 0 then null else 'SALA ' || {_text("s_suppkey % 50")} end
        as NO_COMPLEMENTO,
      'BAIRRO ' || {_text("s_suppkey % 20")} as NO_BAIRRO,
      {_city_of("s_nationkey")} as CO_MUNICIPIO_GESTOR,
      {state_of("s_nationkey")} as CO_ESTADO_GESTOR,
      {_text("s_suppkey % 99999999", 8)} as CO_CEP,
      case when s_suppkey % 4 = 0 then 'n/d' else '-' || {_text("s_suppkey % 30")} || '.5' end
        as NU_LATITUDE,
      '-' || {_text("s_suppkey % 60")} || '.25' as NU_LONGITUDE
    from {{supplier}}
"""


# climate variables and pollutants as multiples of the event value
CLIMATE_FACTORS = {
    "TMIN": 0.5,
    "TMAX": 1.0,
    "PR": 2.0,
    "ETo": 0.25,
    "RH": 4.0,
    "Rs": 0.125,
    "u2": 8.0,
}
POLLUTANT_FACTORS = {
    "c2h6": 1.0,
    "ch3coch3": 2.0,
    "ch4": 3.0,
    "co": 4.0,
    "co2s": 5.0,
    "hcl": 6.0,
    "mmrpm10": 7.0,
    "mmrpm2p5": 8.0,
    "no2": 9.0,
    "sfo3max": 10.0,
    "so2": 11.0,
}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings with the code of their municipality."""
    nation = "user_id % 25"
    return table(spark, sf_dir, "events").selectExpr(
        f"{_city_of(nation)} || {_text('user_id % 25 % 10')} as city", "ts", "value"
    )


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily statistics per municipality."""
    variables: dict[str, Column] = {
        name: F.col("value") * factor for name, factor in CLIMATE_FACTORS.items()
    }
    return daily_statistics(readings(spark, sf_dir), "city", F.to_date("ts"), variables)


def climate_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily statistics with state code and pollutants, without the names of state and region."""
    return climate(spark, sf_dir).select(
        "*",
        F.substring("code_muni", 1, 2).alias("code_state"),
        F.concat(F.lit("U"), F.substring("code_muni", 1, 2)).alias("abbrev_state"),
        *[
            (F.col("TMAX_max") * factor).cast("float").alias(name)
            for name, factor in POLLUTANT_FACTORS.items()
        ],
    )
