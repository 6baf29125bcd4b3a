"""Clustered event tables: the same rows, pruned and joined without an exchange."""

import datetime as dt
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitalspan.layouts import LAYOUTS
from vitalspan.operators.conform import conform
from vitalspan.plans import mortality
from vitalspan.schemas import TABLES
from vitalspan.store import TableStore

YEARS = range(1990, 2003)


def _fill(spark, store):
    """A birth and a death on each of some days; deaths at ages from -1 to 12 years."""
    n = 4000
    day = F.expr("date_add(date'1990-01-01', int(id * 7 % 4600))").cast("timestamp")
    events = spark.range(n).select("id", day.alias("day"), (F.col("id") % 9).alias("place"))
    older = F.expr("int(id * 13 % 4700) - 300")
    born = events.select(
        "id", F.col("day").alias("born"), "place", F.lit(None).cast("timestamp").alias("died")
    )
    died = events.select(
        (F.col("id") + n).alias("id"),
        (F.col("day") - F.make_dt_interval(older)).alias("born"),
        "place",
        F.when(F.col("id") % 50 != 0, F.col("day")).alias("died"),
    )
    zero = F.lit(0)
    person = born.unionByName(died)
    store.append(
        conform(person, TABLES["person"], {
            "person_id": "id", "gender_concept_id": zero, "race_concept_id": zero,
            "ethnicity_concept_id": zero, "year_of_birth": "year(born)", "birth_timestamp": "born",
            "location_id": "place",
        }), "person",
    )
    store.append(
        conform(died, TABLES["death"], {
            "person_id": "id", "death_date": "coalesce(died, timestamp'1995-05-05')",
            "death_timestamp": "died",
        }), "death",
    )
    store.append(
        conform(born, TABLES["datasus_person"], {
            "person_id": "id", "system_source_id": "1", "datasus_person_source_date": "to_date(born)",
            "ingestion_timestamp": "timestamp'2024-01-01'", "source_file": "'f'",
        }), "datasus_person",
    )
    places = spark.range(9).select("id", (F.col("id") + 11).cast("string").alias("state"))
    store.append(
        conform(places, TABLES["location"], {"location_id": "id", "county": "state"}), "location"
    )


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    made = []
    for name, buckets in (("plain", None), ("clustered", 3)):
        store = TableStore(spark, f"t_{name}", str(tmp_path_factory.mktemp(name)))
        store.create_tables(buckets)
        _fill(spark, store)
        made.append(store)
    return made


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_layouts_do_not_show(spark, stores):
    plain, clustered = stores
    for table in LAYOUTS:
        assert clustered.read(table).columns == plain.read(table).columns == TABLES[table].names
        assert rows(clustered.read(table)) == rows(plain.read(table))
    assert "birth_year" in clustered.scan("person").columns
    assert clustered.next_key("person", "person_id") == plain.next_key("person", "person_id")


def test_a_bucket_of_a_year_is_one_file(stores):
    for table in ("person", "death"):
        files = stores[1].scan(table).inputFiles()
        places = Counter((os.path.dirname(f), re.search(r"_(\d{5})\.", f)[1]) for f in files)
        assert set(places.values()) == {1} and len({b for _, b in places}) == 3


@pytest.mark.parametrize("year", [1990, 1994, 1998, 2050])
def test_reports_agree(stores, year):
    plain, clustered = (mortality.mortality_rates_of_store(s, year) for s in stores)
    store = stores[0]
    of_model = mortality.mortality_rates_of_model(
        store.read("person"), store.read("datasus_person"), store.read("death"),
        store.read("location"), year,
    )
    assert rows(clustered) == rows(plain) == rows(of_model)


def test_the_report_opens_its_years_and_joins_without_exchange(spark, stores):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        report = mortality.mortality_rates_of_store(stores[1], 1998)
        plan = report._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    scans = re.findall(r"FileScan parquet (\S+)\[.*?PartitionFilters: \[(.*?)\]", plan)
    of = {name.split(".")[-1]: filters for name, filters in scans if "location" not in name}
    assert set(of) == {"person", "datasus_person", "death"} and all(of.values())
    assert "1998" in of["datasus_person"] and "1998" in of["death"]
    assert not re.search(r"Exchange hashpartitioning\(person_id", plan)
    assert len(re.findall(r"SortMergeJoin \[person_id", plan)) == 2


def test_clustered_tables_take_loads_and_resumed_loads(spark, tmp_path):
    store = TableStore(spark, "t_again", str(tmp_path / "db"))
    store.create_tables(buckets=2)
    frame = conform(
        spark.range(10), TABLES["death"],
        {"person_id": "id", "death_date": f"timestamp'{dt.date(1999, 2, 3)}'"},
    )
    assert store.append(frame, "death") == 10
    assert store.append_new(frame.withColumn("person_id", F.col("person_id") + 5), "death",
                            ["person_id"], (5, 15)) == 5
    assert store.scan("death").where("death_year = 1999").count() == 15
    with pytest.raises(Exception, match="required column death_date is null"):
        store.append(frame.withColumn("death_date", F.lit(None).cast("timestamp")), "death")
    store.drop_tables()


def test_a_bucket_of_a_year_is_a_file_and_years_have_their_own_tasks(spark, tmp_path):
    store = TableStore(spark, "t_dealt", str(tmp_path / "db"))
    store.create_tables(buckets=1)
    frame = conform(
        spark.range(0, 4000, 1, 4), TABLES["death"],
        {"person_id": "id", "death_date": "timestampadd(YEAR, id % 40, timestamp'1960-01-01')"},
    )
    adaptive = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(adaptive, "false")
    try:
        store.append(frame, "death")
    finally:
        spark.conf.unset(adaptive)
    files = [file.split("/")[-1] for file in store.scan("death").inputFiles()]
    assert len(files) == 40
    # with one bucket, its rows of all years were in the same task
    assert len({re.match(r"part-(\d+)", file).group(1) for file in files}) > 1
    assert store.scan("death").count() == 4000
    store.drop_tables()
