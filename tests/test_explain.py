"""What the physical plans must and must not contain."""

import re

import pytest
import records

import __spark_entry__ as entry
from vitalspan.operators.keys import assign_keys_by_position
from vitalspan.plans import births, deaths
from vitalspan.sources.files import with_lineage


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def birth_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("births") / "b.parquet")
    records.births(spark, [{"PESO": "1"}, {"PESO": "2"}]).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def keyed(spark, birth_files):
    scan = with_lineage(spark.read.parquet(birth_files))
    accepted, _ = births.accepted_births(scan)
    return assign_keys_by_position(accepted, scan, "person_id")


def test_dates_are_cast_and_rejected_deaths_told_apart_first(spark):
    """Below the step that carries all columns along, only records without a death time are left."""
    raw = records.deaths(spark, [{"DTOBITO": "32132010"}, {}, {"DTOBITO": "31021999"}, {"DTOBITO": None}])
    _, rejected = deaths.accepted_deaths(raw)
    below = plan(rejected).split("Generate explode")[1].splitlines()[1:]
    parsed = [line for line in below if "Filter" in line and "gettimestamp" in line]
    assert len(parsed) == 1 and "try_cast(" in parsed[0]
    assert sorted(row.DTOBITO for row in rejected.collect()) == ["31021999", "32132010"]


def test_facts_need_no_exchange_of_records(keyed):
    text = plan(births.measurement(keyed))
    # the only shuffle is that of the file sizes, below their broadcast
    records_side = text.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in records_side
    assert "SortMergeJoin" not in text
    assert "Generate inline" in text


def test_facts_read_only_their_columns_and_push_the_null_check(keyed):
    text = plan(births.measurement(keyed))
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    columns = {c.split(":")[0] for c in schema.split(",")}
    assert "PESO" in columns and "GESTACAO" not in columns and "IDADEMAE" not in columns
    assert "IsNotNull(DTNASC)" in text


def test_a_date_is_parsed_once(keyed):
    text = plan(births.observation_period(keyed))
    assert text.count("gettimestamp(") == 1


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.LLM)))
def test_no_python_in_the_row_path(spark, sf_dir, name):
    if name.endswith("_load"):
        pytest.skip("a driver of several jobs, covered by its parts")
    text = plan(entry.queries()[name](spark, sf_dir))
    for word in ("Python", "CartesianProduct", "Scan ExistingRDD", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_year_slice_is_pushed_to_the_scan(spark, tmp_path):
    import datetime as dt

    from pyspark.sql import functions as F

    from vitalspan.functions.clean import in_year

    path = str(tmp_path / "p")
    spark.range(3).withColumn("ts", F.lit(dt.datetime(2019, 5, 1))).write.parquet(path)
    text = plan(spark.read.parquet(path).where(in_year(F.col("ts"), 2019)))
    assert "GreaterThanOrEqual(ts,2019-01-01" in text and "LessThan(ts,2020-01-01" in text


def test_latest_partition_prunes(spark, tmp_path):
    from pyspark.sql import functions as F

    from vitalspan.operators.partitions import latest_partition

    path = str(tmp_path / "p")
    spark.range(9).withColumn("day", F.col("id") % 3).write.partitionBy("day").parquet(path)
    text = plan(latest_partition(spark.read.parquet(path), ["day"]))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert any("day" in f and "ubquery" in f for f in filters)
