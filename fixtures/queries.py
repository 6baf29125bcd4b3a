"""Registered queries: (spark, sf_dir) -> DataFrame, over whole test tables."""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import adapters
from vitalspan.functions.grains import GRAINS
from vitalspan.functions.rates import (
    INFANT_BANDS,
    UNDER_FIVE_BANDS,
    band_label,
    band_ordinal,
    rate_per_thousand,
)
from vitalspan.layouts import WRITING
from vitalspan.operators.conform import conform
from vitalspan.operators.contract import violations
from vitalspan.operators.keys import assign_keys, assign_keys_by_position
from vitalspan.operators.lookup import attach_city, city_rows, facility_rows
from vitalspan.operators.partitions import latest_partition, latest_table_partition
from vitalspan.plans import births, climate, deaths, dimensions, load, mortality, summaries
from vitalspan.plans import vocabulary
from vitalspan.schemas import table_schema
from vitalspan.session import scratch_path
from vitalspan.sources.files import read_delimited, read_folder, read_parquet, with_lineage
from vitalspan.store import TableStore, new_rows

REPORT_YEAR = 1998
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types that read the same in Spark and DuckDB: dates as text, times without zone, floating
    values rounded. Lineage columns name local files and the time of the run and are left out."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if field.name in ("source_file", "source_row", "ingestion_timestamp"):
            continue
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.FloatType):
            column = F.round(column.cast("double"), 4)
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 9)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: comparable(function(spark, sf_dir))
        return function

    return register


# births and deaths


def _births(spark: SparkSession, sf_dir: str) -> DataFrame:
    return births.accepted_births(adapters.births(spark, sf_dir))[0]


def _deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deaths.accepted_deaths(adapters.deaths(spark, sf_dir))[0]


def _keyed_births(spark: SparkSession, sf_dir: str, start: int = 1) -> DataFrame:
    """Births keyed by the position of their order in the file."""
    scan = with_lineage(adapters.table(spark, sf_dir, "orders"))
    return assign_keys_by_position(_births(spark, sf_dir), scan, "person_id", start)


def _keyed_deaths(spark: SparkSession, sf_dir: str, start: int = 1) -> DataFrame:
    """Deaths keyed by the position of their line item in the file."""
    scan = with_lineage(adapters.table(spark, sf_dir, "lineitem"))
    return assign_keys_by_position(_deaths(spark, sf_dir), scan, "person_id", start)


def _densely_keyed(records: DataFrame, natural_key: list[str], *columns: str) -> DataFrame:
    """Records keyed by rank of their natural key. Only the columns in use go through the sort;
    the lineage comes last in the order, so equal natural keys are still told apart."""
    order = [*natural_key, "source_file", "source_row"]
    return assign_keys(records.select(*order, *columns), "person_id", order)


PERSON_SOURCES = ["SEXO", "RACACOR", "CODMUNRES", "CODESTAB"]


@query("mortality_rates")
def mortality_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: from raw birth and death records to the report."""
    location = adapters.city_dimension(spark, sf_dir)
    return mortality.mortality_rates(
        _located_births(spark, sf_dir, location),
        _located_deaths(spark, sf_dir, location),
        location,
        REPORT_YEAR,
    )


def _located_births(spark: SparkSession, sf_dir: str, location: DataFrame) -> DataFrame:
    return attach_city(_births(spark, sf_dir), location).select(
        F.col("location_id_city").alias("location_id"), F.col("event_ts").alias("birth_timestamp")
    )


def _located_deaths(spark: SparkSession, sf_dir: str, location: DataFrame) -> DataFrame:
    return attach_city(_deaths(spark, sf_dir), location).select(
        F.col("location_id_city").alias("location_id"),
        F.col("birth_ts").alias("birth_timestamp"),
        F.col("death_ts").alias("death_timestamp"),
    )


@query("mortality_rates_of_model")
def mortality_rates_of_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over person, extension, death and location tables."""
    location = adapters.city_dimension(spark, sf_dir)
    care_site = adapters.care_site_dimension(spark, sf_dir)
    born = _keyed_births(spark, sf_dir)
    # keys of deaths start where no birth reaches
    died = _keyed_deaths(spark, sf_dir, start=1 << 40)
    person = births.person(born, location, care_site).unionByName(
        deaths.person(died, location, care_site)
    )
    return mortality.mortality_rates_of_model(
        person, born.select("person_id"), deaths.death(died), location, REPORT_YEAR
    )


@query("mortality_rates_of_store")
def mortality_rates_of_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over stored tables, partitioned by the year of the event and bucketed by person."""
    location = adapters.city_dimension(spark, sf_dir)
    care_site = adapters.care_site_dimension(spark, sf_dir)
    store = TableStore(spark, f"vitalspan_{uuid.uuid4().hex[:12]}", scratch_path(spark, "store"))
    store.create_tables(buckets=4)
    born = _keyed_births(spark, sf_dir)
    died = _keyed_deaths(spark, sf_dir, start=1 << 40)
    store.append(births.person(born, location, care_site), "person")
    store.append(deaths.person(died, location, care_site), "person")
    store.append(births.extension(born), "datasus_person")
    store.append(deaths.death(died), "death")
    _append_cities(store, location)
    return mortality.mortality_rates_of_store(store, REPORT_YEAR)


def _append_cities(store: TableStore, cities: DataFrame) -> None:
    values = {c: c for c in ("location_id", "city", "county", "location_source_value")}
    store.append(conform(cities, table_schema("location"), values), "location")


@query("births_by_state")
def births_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = adapters.city_dimension(spark, sf_dir)
    return mortality.births_by_state(
        _located_births(spark, sf_dir, location), location, REPORT_YEAR
    )


@query("deaths_by_age_band")
def deaths_by_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = adapters.city_dimension(spark, sf_dir)
    return mortality.deaths_by_state(
        _located_deaths(spark, sf_dir, location), location, REPORT_YEAR
    )


@query("rate_bands")
def rate_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of line items between 0 and 26 per thousand, with values on the edges of bands."""
    rates = adapters.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        rate_per_thousand(F.col("l_quantity"), 1900 + F.col("l_linenumber") * 50).alias("rate"),
    )
    rate = F.col("rate")
    return rates.select(
        "*",
        band_label(rate, INFANT_BANDS).alias("infant_label"),
        band_ordinal(rate, INFANT_BANDS).alias("infant_ordinal"),
        band_label(rate, UNDER_FIVE_BANDS).alias("under_five_label"),
        band_ordinal(rate, UNDER_FIVE_BANDS).alias("under_five_ordinal"),
    )


@query("clean_births")
def clean_births(spark: SparkSession, sf_dir: str) -> DataFrame:
    return births.clean_births(adapters.births(spark, sf_dir)).select(
        "rec_id", "DTNASC", "HORANASC", "event_ts"
    )


@query("clean_deaths")
def clean_deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deaths.clean_deaths(adapters.deaths(spark, sf_dir)).select(
        *adapters.DEATH_KEY, "DTOBITO", "HORAOBITO", "death_ts", "birth_ts"
    )


@query("rejected_births")
def rejected_births(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = births.accepted_births(adapters.births(spark, sf_dir))[1]
    return rejected.select("rec_id", "DTNASC", "missing_columns")


@query("person_births")
def person_births(spark: SparkSession, sf_dir: str) -> DataFrame:
    return births.person(
        _densely_keyed(_births(spark, sf_dir), ["rec_id"], "event_ts", *PERSON_SOURCES),
        adapters.city_dimension(spark, sf_dir),
        adapters.care_site_dimension(spark, sf_dir),
    )


@query("person_deaths")
def person_deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deaths.person(
        _densely_keyed(_deaths(spark, sf_dir), adapters.DEATH_KEY, "birth_ts", *PERSON_SOURCES),
        adapters.city_dimension(spark, sf_dir),
        adapters.care_site_dimension(spark, sf_dir),
    )


@query("obs_period_births")
def obs_period_births(spark: SparkSession, sf_dir: str) -> DataFrame:
    return births.observation_period(_keyed_births(spark, sf_dir))


@query("obs_period_deaths")
def obs_period_deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deaths.observation_period(_keyed_deaths(spark, sf_dir))


@query("facts_condition")
def facts_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return births.condition_occurrence(_keyed_births(spark, sf_dir))


@query("facts_procedure")
def facts_procedure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return births.procedure_occurrence(_keyed_births(spark, sf_dir))


@query("facts_measurement")
def facts_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return births.measurement(_keyed_births(spark, sf_dir))


@query("facts_observation")
def facts_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return births.observation(_keyed_births(spark, sf_dir))


@query("death_facts_condition")
def death_facts_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deaths.condition_occurrence(_keyed_deaths(spark, sf_dir))


@query("death_facts_procedure")
def death_facts_procedure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deaths.procedure_occurrence(_keyed_deaths(spark, sf_dir))


@query("death_facts_measurement")
def death_facts_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deaths.measurement(_keyed_deaths(spark, sf_dir))


@query("person_extension")
def person_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return births.extension(_keyed_births(spark, sf_dir))


@query("death_extension")
def death_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deaths.extension(_keyed_deaths(spark, sf_dir))


@query("death_records")
def death_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deaths.death(_keyed_deaths(spark, sf_dir))


@query("contract_violations")
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls in the required columns of birth periods, over all raw records."""
    raw = births.clean_births(adapters.births(spark, sf_dir))
    periods = births.observation_period(raw.withColumn("person_id", F.col("rec_id")))
    return violations(periods, table_schema("observation_period"))


# keys and appends


@query("surrogate_keys")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = with_lineage(adapters.table(spark, sf_dir, "orders"))
    keys = orders.select("o_orderkey", "o_custkey", "source_file", "source_row")
    return assign_keys(keys, "order_id", ["o_orderkey", "source_file", "source_row"])


@query("position_keys")
def position_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys by file position of all line items: as many as rows, without gaps."""
    scan = with_lineage(adapters.table(spark, sf_dir, "lineitem"))
    return assign_keys_by_position(scan, scan, "line_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("line_id").alias("distinct_keys"),
        F.min("line_id").alias("lowest"),
        F.max("line_id").alias("highest"),
    )


@query("append_only_new")
def append_only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders up to 1999 are held; appending those from 1997 on adds only the later ones."""
    orders = adapters.table(spark, sf_dir, "orders")
    path = scratch_path(spark, "held")
    orders.where(F.col("o_orderdate") < F.lit("2000-01-01")).write.parquet(path)
    held = read_parquet(spark, path, orders.schema)
    arriving = orders.where(F.col("o_orderdate") >= F.lit("1997-01-01"))
    both = held.unionByName(new_rows(arriving, held, ["o_orderkey"]))
    return both.groupBy(F.year("o_orderdate").alias("order_year")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


# dimensions


def _written_delimited(
    spark: SparkSession, frame: DataFrame, purpose: str, columns: list[str]
) -> DataFrame:
    path = scratch_path(spark, purpose)
    frame.write.csv(path, sep=";", header=True)
    return read_delimited(spark, path, columns)


def _city_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = adapters.table(spark, sf_dir, "nation")
    frame = spark.sql(adapters.CITY_FILE, nation=nation)
    return _written_delimited(spark, frame, "cities", dimensions.CITY_COLUMNS)


def _facility_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = adapters.table(spark, sf_dir, "supplier")
    frame = spark.sql(adapters.FACILITY_FILE, supplier=supplier)
    return _written_delimited(spark, frame, "facilities", adapters.FACILITY_COLUMNS)


@query("dim_city")
def dim_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.city_locations(_city_file(spark, sf_dir))


@query("dim_facility")
def dim_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.facility_locations(
        dimensions.keyed_facilities(_facility_file(spark, sf_dir)), 101
    )


@query("dim_care_site")
def dim_care_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.care_sites(
        dimensions.keyed_facilities(_facility_file(spark, sf_dir)), 5, 101
    )


@query("dim_provider")
def dim_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers out of suppliers, and of the fixed ones those whose key is still free."""
    held = conform(
        adapters.table(spark, sf_dir, "supplier"),
        table_schema("provider"),
        {"provider_id": "s_suppkey + 3", "provider_name": "s_name"},
    )
    return held.unionByName(new_rows(dimensions.seed_providers(spark), held, ["provider_id"]))


@query("dim_rowkind")
def dim_rowkind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per state of the two kinds of locations, told apart by their county."""
    cities = dimensions.city_locations(_city_file(spark, sf_dir))
    facilities = dimensions.facility_locations(
        dimensions.keyed_facilities(_facility_file(spark, sf_dir)), 101
    )
    location = cities.unionByName(facilities)
    city_counts = city_rows(location).groupBy("county").agg(F.count(F.lit(1)).alias("rows"))
    site_counts = facility_rows(location).groupBy("state").agg(F.count(F.lit(1)).alias("rows"))
    return city_counts.select(
        F.lit("city").alias("kind"), F.col("county").alias("state"), "rows"
    ).unionByName(site_counts.select(F.lit("facility").alias("kind"), "state", "rows"))


# climate


@query("climate_daily")
def climate_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.climate(spark, sf_dir)


def _conformed_climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return climate.conform_climate(
        adapters.climate_file(spark, sf_dir), adapters.city_dimension(spark, sf_dir)
    )


@query("climate_conformed")
def climate_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conformed_climate(spark, sf_dir)


@query("climate_flat")
def climate_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat layout; its numbers, text in the table, are shown as numbers here."""
    source = adapters.climate_file(spark, sf_dir).withColumns(
        {
            "name_state": F.col("code_state"),
            "code_region": F.substring("code_muni", 1, 1),
            "name_region": F.col("abbrev_state"),
            "n_days_TN10p": F.dayofmonth("date"),
            "n_days_TX90p": F.month("date"),
            "n_days_TX_gd_35": F.year("date"),
            "index_level_0__": F.concat_ws("-", "code_muni", "date"),
        }
    )
    flat = climate.flat_climate(source)
    numbers = [c for c in flat.columns if c.split("_")[0] in adapters.CLIMATE_FACTORS]
    return flat.withColumns({name: F.col(name).cast("double") for name in numbers})


@query("climate_percentiles")
def climate_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return climate.climate_percentiles(_conformed_climate(spark, sf_dir))


# time


def _register_grain(grain: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return summaries.time_summary(
            adapters.table(spark, sf_dir, "events"),
            "ts",
            grain,
            F.count(F.lit(1)).alias("events"),
            F.round(F.sum("value"), 2).alias("total"),
            F.max("value").alias("highest"),
        )

    query(f"time_grain_{grain}")(run)


for _grain in GRAINS:
    _register_grain(_grain)


@query("time_filter")
def time_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapters.table(spark, sf_dir, "events")
    window = dt.datetime(2024, 1, 8, 6), dt.datetime(2024, 1, 22, 18, 30)
    return (
        summaries.time_filter(events, "ts", *window)
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_ts"))
    )


@query("latest_partition")
def latest_partition_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events")
    events = adapters.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    # one file per day, but several for a day that is much larger than the others
    events.hint("rebalance", F.col("day")).write.partitionBy("day").parquet(path)
    return latest_partition(spark.read.parquet(path), ["day"])


@query("latest_table_partition")
def latest_table_partition_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a catalog table, partitioned by moments and by texts that the catalog escapes,
    some of each unknown."""
    store = TableStore(spark, f"vitalspan_{uuid.uuid4().hex[:12]}", scratch_path(spark, "store"))
    events = adapters.table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case when event_id % 50 <> 0 then cast(date_trunc('day', ts) as timestamp) end as day",
        "case when event_id % 7 <> 0 then event_type || ':1/a' end as kind",
    )
    name = store.name("events")
    events.hint("rebalance", F.col("day")).write.partitionBy("day", "kind").saveAsTable(
        name, format="parquet"
    )
    return latest_table_partition(spark, name)


@query("browse_sample")
def browse_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = adapters.table(spark, sf_dir, "orders")
    return summaries.preview(orders, [F.desc("o_totalprice"), "o_orderkey"], 100)


# vocabulary


def _vocabulary_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(
        VOCABULARY_SQL[name],
        **{t: adapters.table(spark, sf_dir, t) for t in ("part", "lineitem", "orders")},
    )


_DATES = (
    "date_format(l_shipdate, 'yyyyMMdd') as valid_start_date, '20991231' as valid_end_date"
)
VOCABULARY_SQL = {
    "CONCEPT": "select p_partkey as concept_id, p_name as concept_name, p_type as domain_id,"
    " p_brand as vocabulary_id, 'Part' as concept_class_id,"
    " case when p_size > 25 then 'S' end as standard_concept,"
    " 'C' || p_partkey as concept_code, '19700101' as valid_start_date,"
    " '20991231' as valid_end_date, case when p_size < 5 then 'D' end as invalid_reason"
    " from {part}",
    "CONCEPT_CLASS": "select p_type as concept_class_id, 'Class ' || p_type as concept_class_name,"
    " min(p_partkey) as concept_class_concept_id from {part} group by p_type",
    "CONCEPT_SYNONYM": "select p_partkey as concept_id, p_brand || ' ' || p_name as"
    " concept_synonym_name, 4180186 as language_concept_id from {part}",
    "DRUG_STRENGTH": "select l_partkey as drug_concept_id, l_suppkey as ingredient_concept_id,"
    " l_quantity as amount_value, 8576 as amount_unit_concept_id,"
    " case when l_linenumber > 3 then l_discount end as numerator_value,"
    " case when l_linenumber > 3 then 8576 end as numerator_unit_concept_id,"
    " l_tax as denominator_value, 8587 as denominator_unit_concept_id,"
    f" l_linenumber as box_size, {_DATES}, cast(null as string) as invalid_reason"
    " from {lineitem}",
    "VOCABULARY": "select p_brand as vocabulary_id, 'Vocabulary ' || p_brand as vocabulary_name,"
    " cast(null as string) as vocabulary_reference, 'v' || max(p_size) as vocabulary_version,"
    " min(p_partkey) as vocabulary_concept_id from {part} group by p_brand",
    "CONCEPT_ANCESTOR": "select l_partkey as ancestor_concept_id,"
    " l_suppkey as descendant_concept_id, l_linenumber as min_levels_of_separation,"
    " l_linenumber + 1 as max_levels_of_separation from {lineitem}",
    "CONCEPT_RELATIONSHIP": "select l_partkey as concept_id_1, l_suppkey as concept_id_2,"
    f" 'Maps to ' || l_returnflag as relationship_id, {_DATES},"
    " case when l_linestatus = 'F' then 'D' end as invalid_reason from {lineitem}",
    "DOMAIN": "select o_orderpriority as domain_id, 'Domain ' || o_orderpriority as domain_name,"
    " min(o_orderkey) as domain_concept_id from {orders} group by o_orderpriority",
    "RELATIONSHIP": "select l_returnflag || l_linestatus as relationship_id,"
    " 'From ' || l_returnflag || ' to ' || l_linestatus as relationship_name,"
    " '0' as is_hierarchical, '1' as defines_ancestry,"
    " l_linestatus || l_returnflag as reverse_relationship_id,"
    " count(*) as relationship_concept_id from {lineitem} group by l_returnflag, l_linestatus",
}


def _register_vocabulary(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_path(spark, "vocabulary")
        source = _vocabulary_source(spark, sf_dir, name)
        source.write.csv(f"{folder}/{name}.csv", sep="\t", header=True)
        return vocabulary.read_vocabulary(spark, folder, name)[0]

    query(f"vocab_{name.lower()}")(run)


for _file in VOCABULARY_SQL:
    _register_vocabulary(_file)


@query("code_to_concept")
def code_to_concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of line items, written with a dot, matched to the concepts of parts."""
    part = _vocabulary_source(spark, sf_dir, "CONCEPT")
    records = adapters.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "'C' || (l_partkey div 10) || '.' || (l_partkey % 10) as source_code",
    )
    return vocabulary.code_to_concept(records, "source_code", part, "Brand#2")


# folders and loads


@query("folder_ingest")
def folder_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly files, the older ones without a column, read in one scan."""
    folder = scratch_path(spark, "yearly")
    orders = adapters.table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    old, new = F.col("year") < REPORT_YEAR, F.col("year") >= REPORT_YEAR
    orders.where(old).drop("o_orderpriority").write.partitionBy("year").parquet(f"{folder}/old")
    orders.where(new).write.partitionBy("year").parquet(f"{folder}/new")
    read = with_lineage(read_folder(spark, folder, "part-*.parquet"))
    in_file = F.regexp_extract("source_file", r"year=(\d{4})", 1).cast("int")
    return read.groupBy(in_file.alias("file_year")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("o_orderpriority").alias("with_priority"),
        F.count_if(F.year("o_orderdate") == in_file).alias("in_their_file"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
    )


def _distinct_keys(keys: DataFrame, key: str) -> DataFrame:
    """``distinct_keys``, the exact number of different whole numbers in ``key``.

    64 neighbours share a word of bits, and keys of a load lie side by side, so words are combined
    before they are exchanged. Scattered keys cost no more than a row each.
    """
    bit = F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.pmod(key, F.lit(64)).cast("int")
    )
    words = (
        keys.where(F.col(key).isNotNull())
        .groupBy(F.call_function("shiftright", F.col(key).cast("long"), F.lit(6)).alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )
    return words.agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("distinct_keys"))


def _days_of_persons(days: DataFrame) -> DataFrame:
    """Rows of each person, how many have a day, and the least and the greatest of their days."""
    return days.groupBy("person_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("own_day").alias("dated"),
        F.min("own_day").alias("low"),
        F.max("own_day").alias("high"),
    )


def _load_summary(store: TableStore, tables: dict[str, tuple[str, str]], event: DataFrame) -> DataFrame:
    """Rows and distinct keys of each table after a load, how many have the day of their person's
    ``event``, and the sum of those days. Rows tied to another person would have another day.

    Events grow with the load, and Spark takes a few columns of a wide stored table for much
    smaller than they are, so the join by person is a sorted one. Rows are exchanged once, as those
    of a person, with the least and the greatest of their days. The same pass gives the range of the
    persons for whom the two differ; only rows in that range are looked at one by one.
    """
    event_columns = event.toDF("event_person", "event_ts")
    event = event_columns.select("event_person", F.to_date("event_ts").alias("event_day")).hint("merge")
    own = F.col("person_id") == F.col("event_person")
    several = F.expr("low < high AND dated > 1 AND n > 1")
    parts = []
    for table, (key, date) in tables.items():
        days = store.read(table).select("person_id", F.to_date(F.expr(date)).alias("own_day"))
        one_day = (F.col("low") == F.col("high")) & (F.col("low") == F.col("event_day"))
        mixed = F.when(several, F.col("person_id"))
        joined = _days_of_persons(days).join(event, own, "left").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(one_day, F.col("dated"))), F.lit(0)).alias("of_one_day"),
            F.sum(F.datediff("event_day", F.lit("1970-01-01").cast("date")) * F.col("n")).alias("days"),
            F.min(mixed).alias("first_mixed"),
            F.max(mixed).alias("last_mixed"),
        )
        # one value, so that every use of it is the same subquery
        found = joined.select(F.struct(*joined.columns)).scalar()
        near = days.where(
            F.col("person_id").between(found.getField("first_mixed"), found.getField("last_mixed"))
        )
        mixed_persons = _days_of_persons(near).where(several).select("person_id")
        rows_of_mixed = (
            near.join(mixed_persons.hint("merge"), "person_id", "left_semi")
            .join(event, own)
            .agg(F.count_if(F.col("own_day") == F.col("event_day")).alias("of_mixed"))
        )
        counted = rows_of_mixed.crossJoin(_distinct_keys(store.read(table), key))
        parts.append(
            counted.select(
                F.lit(table).alias("table_name"),
                found.getField("rows").alias("rows"),
                "distinct_keys",
                (found.getField("of_one_day") + F.col("of_mixed")).alias("of_their_day"),
                found.getField("days").alias("days"),
            )
        )
    return functools.reduce(DataFrame.unionByName, parts)


def _new_store(spark: SparkSession) -> TableStore:
    name = f"vitalspan_{uuid.uuid4().hex[:12]}"
    store = TableStore(spark, name, scratch_path(spark, "store"))
    store.create_tables()
    return store


FACT_KEYS = {
    "person": ("person_id", "birth_timestamp"),
    "observation_period": ("observation_period_id", "observation_period_start_date"),
    "condition_occurrence": ("condition_occurrence_id", "condition_start_date"),
    "procedure_occurrence": ("procedure_occurrence_id", "procedure_date"),
    "measurement": ("measurement_id", "measurement_date"),
}


@query("births_load")
def births_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole load of birth files, run twice: the second run finds nothing new."""
    store = _new_store(spark)
    path = scratch_path(spark, "births")
    births_of_orders = adapters.births(spark, sf_dir).drop("rec_id", "source_file", "source_row")
    births_of_orders.write.options(**WRITING).parquet(path)
    load.load_births(store, path)
    load.load_births(store, path)
    more = {
        "observation": ("observation_id", "observation_date"),
        "datasus_person": ("person_id", "datasus_person_source_date"),
    }
    event = store.read("person").select("person_id", "birth_timestamp")
    return _load_summary(store, {**FACT_KEYS, **more}, event)


@query("deaths_load")
def deaths_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole load of death files."""
    store = _new_store(spark)
    path = scratch_path(spark, "deaths")
    adapters.deaths(spark, sf_dir).drop(
        *adapters.DEATH_KEY, "source_file", "source_row"
    ).write.options(**WRITING).parquet(path)
    load.load_deaths(store, path)
    more = {
        "death": ("person_id", "death_timestamp"),
        "datasus_death": ("person_id", "datasus_person_source_date"),
        # neither has a day of the death
        "person": ("person_id", "cast(null as date)"),
        "observation_period": ("observation_period_id", "cast(null as date)"),
    }
    event = store.read("death").select("person_id", "death_timestamp")
    return _load_summary(store, {**FACT_KEYS, **more}, event)


@query("publish_table")
def publish_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Births by state as a published table, replaced once."""
    store = TableStore(spark, f"vitalspan_{uuid.uuid4().hex[:12]}", scratch_path(spark, "store"))
    result = births_by_state(spark, sf_dir)
    location = scratch_path(spark, "published")
    store.publish(result, "births_by_state", location)
    return store.publish(result, "births_by_state", location, if_exists="replace")


def _facility_path(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "facilities")
    frame = spark.sql(adapters.FACILITY_FILE, supplier=adapters.table(spark, sf_dir, "supplier"))
    frame.write.csv(path, sep=";", header=True)
    return path


@query("facilities_load")
def facilities_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities by the file's own header, loaded twice: each site with its address."""
    store, path = _new_store(spark), _facility_path(spark, sf_dir)
    load.load_facilities(store, path)
    load.load_facilities(store, path)
    sites = store.read("care_site").where(F.col("location_id").isNotNull())
    places = store.read("location").drop("location_source_value")
    joined = sites.join(places, "location_id")
    return joined.select("care_site_source_value", "care_site_name", "address_1", "city")


@query("cities_load")
def cities_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipalities loaded twice, with one of an unknown state."""
    store, path = _new_store(spark), scratch_path(spark, "cities")
    cities = spark.sql(adapters.CITY_FILE, nation=adapters.table(spark, sf_dir, "nation"))
    unknown = cities.select(
        "OID_", "nome", F.concat(F.lit("99"), F.substring("geocodigo", 3, 5)).alias("geocodigo"),
        "Longitude", "Latitude",
    )
    cities.unionByName(unknown).write.csv(path, sep=";", header=True)
    load.load_cities(store, path)
    load.load_cities(store, path)
    return (
        store.read("location")
        .select(F.lit("loaded").alias("outcome"), F.col("location_source_value").alias("code"))
        .unionByName(
            store.read("rejected_cities").select(
                F.lit("rejected").alias("outcome"), F.col("geocodigo").alias("code")
            )
        )
    )


def _climate_path(spark: SparkSession, sf_dir: str, flat: bool) -> str:
    path = scratch_path(spark, "climate")
    days = adapters.climate_file(spark, sf_dir)
    if flat:
        days = days.withColumns({c: F.lit(None).cast("string") for c in (
            "name_state", "code_region", "name_region", "n_days_TN10p", "n_days_TX90p",
            "n_days_TX_gd_35", "index_level_0__")})
    # every day again, and a day without a city for each
    nowhere = days.withColumn("code_muni", F.lit(None).cast("string"))
    days.unionByName(days).unionByName(nowhere).write.parquet(path)
    return path


@query("climate_load")
def climate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Climate days with repeats, loaded twice: one row of each city and day."""
    store, path = _new_store(spark), _climate_path(spark, sf_dir, flat=False)
    _append_cities(store, adapters.city_dimension(spark, sf_dir))
    load.load_climate(store, path)
    load.load_climate(store, path)
    loaded = store.read("datasus_climate")
    return loaded.select("city_code", "city_name", F.col("measurement_date").alias("day"))


@query("climate_years_load")
def climate_years_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three years of flat climate files loaded one after the other, then all again.

    A year's load has nothing to look for in the files of the others."""
    store, path = _new_store(spark), _climate_path(spark, sf_dir, flat=True)
    days, folders = read_parquet(spark, path), []
    for later in range(3):
        folder = scratch_path(spark, "climate-year")
        moved = F.add_months(F.to_date("date"), 12 * later).cast(days.schema["date"].dataType)
        days.withColumn("date", moved).write.parquet(folder)
        folders.append(folder)
    for given in [*folders, folders]:
        load.load_climate_flat(store, given)
    loaded = store.read("clima_flat").groupBy(F.year(F.to_date("date")).alias("year"))
    return loaded.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("code_muni", "date").alias("city_days"),
        F.count_distinct("date").alias("days"),
    )


@query("climate_flat_load")
def climate_flat_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat layout, with repeats, loaded twice."""
    store, path = _new_store(spark), _climate_path(spark, sf_dir, flat=True)
    load.load_climate_flat(store, path)
    load.load_climate_flat(store, path)
    return store.read("clima_flat").select("code_muni", F.col("date").alias("day"))


@query("vocabulary_load")
def vocabulary_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vocabulary files, one below a folder, with quotes and lines that do not fit, twice."""
    store, folder = _new_store(spark), scratch_path(spark, "download")
    for name in VOCABULARY_SQL:
        source = _vocabulary_source(spark, sf_dir, name)
        if name == "CONCEPT":
            # an opening quote in each name, and a line without the other columns for each concept
            source = source.withColumn("concept_name", F.concat(F.lit('"'), "concept_name"))
            texts = source.select(*[F.col(c).cast("string") for c in source.columns])
            broken = texts.withColumns(
                {c: F.concat(F.lit("x"), c) if c == "concept_id" else F.col(c) for c in texts.columns}
            )
            texts.unionByName(broken).write.csv(
                f"{folder}/sub/CONCEPT.csv", sep="\t", header=True, quote="", escapeQuotes=False
            )
        else:
            path = f"{folder}/{name}.csv"
            source.write.csv(path, sep="\t", header=True, quote="", escapeQuotes=False)
    load.load_vocabulary(store, folder)
    load.load_vocabulary(store, folder)
    tables = [
        store.read(name.lower()).agg(
            F.lit(name.lower()).alias("table_name"), F.count(F.lit(1)).alias("rows")
        )
        for name in VOCABULARY_SQL
    ]
    tables.append(
        store.read("rejected_vocabulary").agg(
            F.lit("rejected").alias("table_name"), F.count(F.lit(1)).alias("rows")
        )
    )
    return functools.reduce(DataFrame.unionByName, tables)


@query("ddl_script")
def ddl_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables made and filled by a script with several statements on a line and odd semicolons."""
    store = TableStore(spark, f"vitalspan_{uuid.uuid4().hex[:12]}", scratch_path(spark, "store"))
    view = f"orders_{uuid.uuid4().hex[:8]}"
    adapters.table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    script = scratch_path(spark, "script")
    a, b = store.name("a"), store.name("b")
    text = (
        f"-- first; two tables\nCREATE TABLE {a} (k bigint, t string) USING parquet; "
        f"CREATE TABLE {b} (k bigint, t string) USING parquet; -- both\nNONSENSE;\n"
        f"INSERT INTO {a} SELECT o_orderkey, 'x;--y' FROM {view}; /* then; */ INSERT INTO {b} "
        f"SELECT k, t FROM {a}\n WHERE k % 2 = 0"
    )
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(script)
    try:
        store.run_script(script)
    finally:
        spark.catalog.dropTempView(view)
    both = store.read("a").select(F.lit("a").alias("name"), "k", "t")
    both = both.unionByName(store.read("b").select(F.lit("b").alias("name"), "k", "t"))
    return both.groupBy("name", "t").agg(F.count(F.lit(1)).alias("rows"), F.sum("k").alias("total"))
