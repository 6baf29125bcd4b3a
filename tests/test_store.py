import datetime as dt
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
import records
from pyspark.sql import functions as F

from vitalspan.operators.key_filter import may_hold
from vitalspan.operators.partitions import latest_partition, latest_table_partition
from vitalspan.plans import births, load, summaries
from vitalspan.schemas import TABLES
from vitalspan.sources.files import read_folder, with_lineage
from vitalspan.store import TableStore, export_jdbc, split_statements
from vitalspan.streaming.folder import load_arrivals


def test_create_and_drop_all_tables(spark, store):
    store.create_tables()
    names = {t.name for t in spark.catalog.listTables(store.database)}
    assert names == set(TABLES)
    store.create_tables()
    store.drop_tables()
    assert spark.catalog.listTables(store.database) == []


def test_moments_are_stored_as_numbers(spark, store):
    """Unless the session says how; its settings are as before afterwards."""
    key = "spark.sql.parquet.outputTimestampType"
    day = dt.datetime(2020, 2, 29, 23, 59)
    rows = spark.createDataFrame([(day,), (None,)], "moment timestamp")
    store.create("moments", rows.schema)
    store.append(rows.coalesce(1), "moments")
    assert spark.conf.get(key, None) is None
    kinds = {stored_kind(name) for name in store.read("moments").inputFiles()}
    assert kinds == {"INT64"}
    spark.conf.set(key, "INT96")
    try:
        store.append(rows.coalesce(1), "moments")
        assert spark.conf.get(key, None) == "INT96"
    finally:
        spark.conf.unset(key)
    kinds = {stored_kind(name) for name in store.read("moments").inputFiles()}
    assert kinds == {"INT64", "INT96"}
    assert sorted(row.moment or dt.datetime.min for row in store.read("moments").collect()) == [
        dt.datetime.min, dt.datetime.min, day, day]


def stored_kind(file):
    return pq.ParquetFile(file.removeprefix("file:")).schema.column(0).physical_type


def test_append_is_by_name_and_counts(spark, store):
    store.create("death", TABLES["death"])
    frame = spark.range(5).select(
        F.lit("R99").alias("cause_source_value"),
        F.col("id").alias("person_id"),
        F.lit(dt.datetime(2020, 1, 1)).alias("death_date"),
        F.lit(None).cast("timestamp").alias("death_timestamp"),
        *[
            F.lit(None).cast("long").alias(c)
            for c in ("death_type_concept_id", "cause_concept_id", "cause_source_concept_id")
        ],
    )
    assert store.append(frame, "death") == 5
    assert store.append(frame.limit(0), "death") == 0
    assert store.read("death").where("cause_source_value = 'R99'").count() == 5
    assert store.append_new(frame, "death", ["person_id"]) == 0
    shifted = frame.withColumn("person_id", F.col("person_id") + 3)
    assert store.append_new(shifted, "death", ["person_id"], (3, 8)) == 3
    assert store.read("death").agg(F.count_distinct("person_id")).first()[0] == 8
    assert store.next_key("death", "person_id") == 8


def test_a_null_in_a_required_column_fails_the_append(spark, store):
    store.create("domain", TABLES["domain"])
    rows = [("Drug", "Drug", 13), ("Gap", None, 14)]
    frame = spark.createDataFrame(
        rows, "domain_id string, domain_name string, domain_concept_id long"
    )
    with pytest.raises(Exception, match="required column domain_name is null"):
        store.append(frame, "domain")
    assert store.read("domain").isEmpty()
    assert store.append(frame.where("domain_name is not null"), "domain") == 1


def test_publish(spark, store, tmp_path):
    frame = spark.range(3).withColumn("x", F.lit(1.5))
    location = str(tmp_path / "published")
    assert store.publish(frame, "result", location).count() == 3
    with pytest.raises(Exception, match="already exists"):
        store.publish(frame, "result", location)
    assert store.publish(frame.limit(1), "result", location, if_exists="replace").count() == 1
    with pytest.raises(ValueError):
        store.publish(frame, "result", location, if_exists="append")


def test_a_published_result_may_read_the_table_it_replaces(spark, store, tmp_path):
    location = str(tmp_path / "published")
    store.publish(spark.range(3), "result", location)
    more = store.read("result").unionAll(spark.range(5, 7).toDF("id"))
    assert store.publish(more, "result", location, if_exists="replace").count() == 5
    broken = store.read("result").select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        store.publish(broken, "result", location, if_exists="replace")
    assert store.read("result").count() == 5


def test_append_new_takes_nulls_and_repeats_once(spark, store):
    frame = spark.createDataFrame(
        [(None, 1, "b"), (None, 1, "a"), (2, None, "c"), (2, 3, None), (2, 3, "d")],
        "a long, b long, c string",
    )
    store.create("t", frame.schema)
    assert store.append_new(frame, "t", ["a", "b"]) == 3
    assert store.append_new(frame, "t", ["a", "b"]) == 0


def _days(spark, year, cities):
    return spark.range(60).selectExpr(
        f"id % {cities} AS city", f"date_add(date '{year}-01-01', int(id)) AS day",
        "timestamp_seconds(id) AS at", "cast(id AS string) AS reading",
    )


@pytest.mark.parametrize("key", [["city", "day"], ["day"], ["day", "reading"]])
def test_appends_look_into_files_that_can_match_only(spark, store, key):
    store.create("days", _days(spark, 2020, 3).schema)
    per_year = []
    for year in (2020, 2021, 2022):
        before = set(store.read("days").inputFiles())
        staged, bounds = store.stage(_days(spark, year, 3), "days", key)
        assert store.files_that_may_hold(before, bounds, "days") == []
        assert store.append_staged(staged, bounds, "days", key) == 60
        per_year.append(set(store.read("days").inputFiles()) - before)
    files = set(store.read("days").inputFiles())
    _, bounds = store.stage(_days(spark, 2022, 3).limit(7), "days", key)
    assert set(store.files_that_may_hold(files, bounds, "days")) == per_year[2]
    late = _days(spark, 2022, 3).where("day > date'2022-02-20'")
    assert store.append_new(late, "days", key) == 0
    more = late.unionByName(_days(spark, 2023, 3)).unionByName(_days(spark, 2023, 3))
    assert store.append_new(more, "days", key) == 60
    # files without bounds are always looked into
    store.append(_days(spark, 2030, 3), "days")
    assert store.append_new(_days(spark, 2030, 3), "days", key) == 0


def test_bounds_of_nulls_texts_and_moments(spark, store):
    schema = "at timestamp, name string, n decimal(9,2), x double"
    rows = [(dt.datetime(2020, 1, 1, 5), "Zé", 1, 0.5), (None, "", None, None), (None, None, 2, -1.0)]
    frame = spark.createDataFrame([(a, b, None if c is None else Decimal(c), d) for a, b, c, d in rows], schema)
    for key in (["at"], ["name", "n"], ["x"], ["at", "name", "n", "x"]):
        table = "t_" + "_".join(key)
        store.create(table, frame.schema)
        distinct = frame.select(*key).distinct().count()
        assert store.append_new(frame, table, key) == distinct
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        try:
            assert store.append_new(frame, table, key) == 0
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        other = frame.where("name is null").withColumns({c: F.lit(None).cast(frame.schema[c].dataType) for c in key})
        assert store.append_new(other, table, key) == (key not in (["at"], ["x"]))


def test_appends_move_matching_rows_only(spark, store):
    """Of rows that are neither held nor repeated none is shuffled, nor are held rows that miss."""
    many = spark.range(0, 3_000_000, 3, 4).selectExpr("id", "'x' AS v")
    store.create("ids", many.schema)
    store.append_new(many, "ids", ["id"])
    some = spark.range(0, 3000).selectExpr("id", "'y' AS v")
    held = store.read("ids")
    moved = may_hold(held, some, ["id"], "maybe").where("maybe").count()
    assert 1000 <= moved < 3000
    assert store.append_new(some, "ids", ["id"]) == 2000
    assert store.read("ids").where("v = 'x'").count() == 1_000_000


def test_facilities_without_a_code_are_set_aside_once(spark, loaded, tmp_path):
    path = tmp_path / "sites.csv"
    header = ("CO_CNES;NO_RAZAO_SOCIAL;NO_LOGRADOURO;NU_ENDERECO;NO_COMPLEMENTO;NO_BAIRRO;"
              "CO_MUNICIPIO_GESTOR;CO_ESTADO_GESTOR;CO_CEP;NU_LATITUDE;NU_LONGITUDE")  # fmt: skip
    path.write_text(f"{header}\n77;A;R;1;;B;120040;12;69900;1;2\n;B;R;2;;B;120040;12;69900;1;2\n")
    places = loaded.read("location").count()
    for run in range(3):
        outcome = load.load_facilities(loaded, str(path))
        assert outcome["location"] == (run == 0)
    assert loaded.read("location").count() == places + 1
    assert [r.NO_RAZAO_SOCIAL for r in loaded.read("rejected_facilities").collect()] == ["B"]


def test_statements_end_outside_quotes_and_comments():
    text = "a 'x;''y'; b -- c;\n; /* d; */ e `f;g`;; \"h\\\";\" ;\n-- last"
    assert split_statements(text) == ["a 'x;''y'", "b", "e `f;g`", '"h\\";"']


def test_replace(spark, store):
    store.replace(spark.range(3), "numbers")
    store.replace(spark.range(2), "numbers")
    assert store.read("numbers").count() == 2


def test_script_runs_over_errors_and_lines(spark, store, tmp_path):
    script = tmp_path / "setup.sql"
    script.write_text(
        f"-- a comment\nCREATE TABLE {store.database}.a\n  (x bigint) USING parquet;\n"
        "CREATE NONSENSE;\n"
        f"INSERT INTO {store.database}.a SELECT length('p;q');\n"
    )
    outcome = store.run_script(str(script))
    assert [error is None for _, error in outcome] == [True, False, True]
    assert store.read("a").first().x == 3


def test_jdbc_export_hands_over_its_arguments():
    calls = []

    class Writer:
        def jdbc(self, **arguments):
            calls.append(arguments)

    class Frame:
        write = Writer()

    export_jdbc(Frame(), "jdbc:x:y", "clima", {"user": "u"})
    assert calls == [
        {"url": "jdbc:x:y", "table": "clima", "mode": "overwrite", "properties": {"user": "u"}}
    ]


def test_latest_partition_compares_values_not_text(spark, store, tmp_path):
    rows = [(9, 30, "a"), (10, 2, "b"), (10, 11, "c")]
    frame = spark.createDataFrame(rows, "y int, m int, v string")
    path = str(tmp_path / "parts")
    frame.write.partitionBy("y", "m").parquet(path)
    assert [r.v for r in latest_partition(spark.read.parquet(path), ["y", "m"]).collect()] == ["c"]
    name = store.name("parts")
    frame.write.partitionBy("y", "m").format("parquet").saveAsTable(name)
    assert [r.v for r in latest_table_partition(spark, name).collect()] == ["c"]
    # without one of the partition columns in the projection, that column does not filter
    assert latest_table_partition(spark, name, ["y", "v"]).count() == 2
    assert latest_table_partition(spark, name, ["v"]).count() == 3
    frame.write.format("parquet").saveAsTable(store.name("whole"))
    assert latest_table_partition(spark, store.name("whole")).count() == 3


def test_preview_and_browse(spark):
    frame = spark.range(50)
    assert [r.id for r in summaries.preview(frame, [F.desc("id")], 2).collect()] == [49, 48]
    assert summaries.browse(frame, "id", 7).count() == 7


def test_time_filter_types_its_literals(spark):
    rows = [(dt.date(2020, 1, d), dt.datetime(2020, 1, d, 12)) for d in (1, 2, 3)]
    frame = spark.createDataFrame(rows, "d date, t timestamp")
    start, end = dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 3)
    assert summaries.time_filter(frame, "d", start, end).count() == 1
    assert summaries.time_filter(frame, "t", start, end).count() == 1


def test_folder_with_changing_columns(spark, tmp_path):
    folder = tmp_path / "years"
    spark.range(3).write.parquet(str(folder / "a" / "births_2010.parquet"))
    spark.range(2).withColumn("x", F.lit("1")).write.parquet(str(folder / "births_2011.parquet"))
    (folder / "notes.txt").write_text("no data")
    merged = read_folder(spark, str(folder))
    assert merged.count() == 5 and merged.where("x is not null").count() == 2
    declared = read_folder(spark, str(folder), schema="id long, x string, y string")
    assert declared.count() == 5 and declared.where("y is not null").count() == 0


@pytest.fixture
def loaded(spark, store):
    store.create_tables()
    return store


def birth_file(spark, path, count, without=()):
    rows = [{"PESO": str(3000 + i), "RACACOR": "1"} for i in range(count)]
    frame = records.births(spark, [*rows, {"DTNASC": "32132010"}], without)
    frame.coalesce(1).write.parquet(str(path))
    return str(path)


def keys_of(store, table, key):
    frame = store.read(table)
    return frame.count(), frame.select(key).distinct().count()


def test_loading_twice_adds_nothing(spark, loaded, tmp_path):
    first = birth_file(spark, tmp_path / "b2010.parquet", 4)
    counts = load.load_births(loaded, first)
    assert counts["person"] == 4 and counts["condition_occurrence"] == 40
    assert counts["rejected_births"] == 1
    assert load.load_births(loaded, first) == {}
    # a second file, without an optional column, gets keys of its own
    second = birth_file(spark, tmp_path / "b2011.parquet", 3, without=["TPROBSON"])
    again = load.load_births(loaded, [first, second])
    assert again["person"] == 3 and again["measurement"] == 9
    assert keys_of(loaded, "person", "person_id") == (7, 7)
    assert keys_of(loaded, "measurement", "measurement_id") == (25, 25)
    orphans = loaded.read("measurement").join(loaded.read("person"), "person_id", "left_anti")
    assert orphans.isEmpty()


def test_births_and_deaths_share_the_person_table(spark, loaded, tmp_path):
    load.load_births(loaded, birth_file(spark, tmp_path / "b.parquet", 2))
    path = str(tmp_path / "d.parquet")
    records.deaths(spark, [{"CAUSABAS": "I10"}, {"CAUSABAS": "I11"}]).write.parquet(path)
    counts = load.load_deaths(loaded, path)
    assert counts["death"] == 2 and counts["observation_period"] == 4
    assert keys_of(loaded, "person", "person_id") == (4, 4)
    assert keys_of(loaded, "observation_period", "observation_period_id") == (6, 6)


def test_a_broken_load_is_taken_up_with_its_keys(spark, loaded, tmp_path, monkeypatch):
    first = birth_file(spark, tmp_path / "b1.parquet", 4)
    other = birth_file(spark, tmp_path / "b2.parquet", 2)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(births, "measurement", fail)
        with pytest.raises(RuntimeError):
            load.load_births(loaded, first)
    # another file may come in between: the keys of the broken load stay reserved
    load.load_births(loaded, other)
    load.load_births(loaded, [first, other])
    for table, key, rows in [
        ("person", "person_id", 6),
        ("condition_occurrence", "condition_occurrence_id", 60),
        ("measurement", "measurement_id", 24),
        ("datasus_person", "person_id", 6),
    ]:
        assert keys_of(loaded, table, key) == (rows, rows)


def test_dimension_loads(spark, loaded, tmp_path):
    cities = tmp_path / "cities.csv"
    cities.write_text("OID_;nome;geocodigo;Longitude;Latitude\n1;Bujari;1200138;-67,9;-9,8\n")
    assert load.load_cities(loaded, str(cities)) == 1
    assert load.load_cities(loaded, str(cities)) == 0
    assert load.load_cities(loaded, str(cities), "municipality") == 1
    columns = ["CO_CNES", "NO_RAZAO_SOCIAL", "NO_LOGRADOURO", "NU_ENDERECO", "NO_COMPLEMENTO"]
    columns += ["NO_BAIRRO", "CO_MUNICIPIO_GESTOR", "CO_ESTADO_GESTOR", "CO_CEP"]
    columns += ["NU_LATITUDE", "NU_LONGITUDE"]
    sites = tmp_path / "sites.csv"
    sites.write_text(
        ";".join(columns) + "\n"
        + '0012345;"HOSPITAL; GERAL";RUA A;10;;CENTRO;120013;12;69900000;-9.8;x\n'
    )
    assert load.load_facilities(loaded, str(sites), columns) == {
        "location": 1,
        "care_site": 3,
        "provider": 5,
    }
    assert load.load_facilities(loaded, str(sites), columns) == {
        "location": 0,
        "care_site": 0,
        "provider": 0,
    }
    site = loaded.read("care_site").where("care_site_source_value = '0012345'").first()
    place = loaded.read("location").where(F.col("location_id") == site.location_id).first()
    assert site.care_site_name == "HOSPITAL; GERAL"
    assert (place.address_1, place.longitude, place.county) == ("RUA A 10", None, None)


def test_only_files_with_rejects_are_read_in_full(spark, loaded, tmp_path, monkeypatch):
    clean = [{"DTNASC": "03022011"}, {"DTNASC": "04022011"}]
    records.births(spark, clean).coalesce(1).write.parquet(str(tmp_path / "clean"))
    records.births(spark, [*clean, {"DTNASC": "31022011"}]).coalesce(1).write.parquet(
        str(tmp_path / "mixed")
    )
    wide, scan = [], load._scan
    monkeypatch.setattr(load, "_scan", lambda store, files: wide.append(len(files)) or scan(store, files))
    assert load.load_births(loaded, str(tmp_path / "clean"))["rejected_births"] == 0
    assert wide == [1]  # the batch's own scan, whose targets each read their columns
    held = loaded.read("rejected_births").count()
    counts = load.load_births(loaded, [str(tmp_path / "clean"), str(tmp_path / "mixed")])
    assert (counts["person"], counts["rejected_births"]) == (2, 1) and wide == [1, 1, 1]
    aside = loaded.read("rejected_births").where("source_file LIKE '%mixed%'").collect()
    assert len(aside) == 1 and "31022011" in aside[0].record
    assert loaded.read("rejected_births").count() == held + 1


def test_climate_loads_add_new_days_only(spark, loaded, tmp_path):
    from test_plans import climate_row

    path = str(tmp_path / "c1.parquet")
    climate_row(spark).write.parquet(path)
    assert load.load_climate(loaded, path) == 1
    assert load.load_climate(loaded, path) == 0
    later = str(tmp_path / "c2.parquet")
    climate_row(spark, date="2010-01-02").write.parquet(later)
    assert load.load_climate(loaded, [path, later]) == 1
    flat = climate_row(
        spark, name_state="x", code_region="1", name_region="y", n_days_TN10p=0, n_days_TX90p=0,
        n_days_TX_gd_35=0, index_level_0__=0,
    )
    flat_path = str(tmp_path / "flat.parquet")
    flat.write.parquet(flat_path)
    assert load.load_climate_flat(loaded, flat_path) == 1
    assert load.load_climate_flat(loaded, flat_path) == 0


def test_vocabulary_load(spark, loaded, tmp_path):
    (tmp_path / "DOMAIN.csv").write_text(
        "domain_id\tdomain_name\tdomain_concept_id\nDrug\tDrug\t13\n"
    )
    (tmp_path / "CONCEPT_SYNONYM.csv").write_text(
        "concept_id\tconcept_synonym_name\tlanguage_concept_id\n1\ta\t2\n1\tb\t2\n"
    )
    assert load.load_vocabulary(loaded, str(tmp_path)) == {"concept_synonym": 2, "domain": 1}
    assert load.load_vocabulary(loaded, str(tmp_path)) == {"concept_synonym": 0, "domain": 0}


def test_vocabulary_load_keeps_every_line(spark, loaded, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "DOMAIN.csv").write_text(
        "domain_id\tdomain_name\tdomain_concept_id\nDrug\t\"Drug\t13\nX\tY\tnone\nB\tZ\t4\n"
    )
    strength = "drug_concept_id\tingredient_concept_id"
    for name in ("amount_value", "amount_unit_concept_id", "numerator_value",
                 "numerator_unit_concept_id", "denominator_value", "denominator_unit_concept_id",
                 "box_size", "valid_start_date", "valid_end_date", "invalid_reason"):
        strength += "\t" + name
    row = "\n1\t2\t\t\t\t\t\t\t\t{}\t20991231\t"
    (tmp_path / "DRUG_STRENGTH.csv").write_text(
        strength + row.format("20000101") + row.format("20100101") + "\n"
    )
    for expected in ({"domain": 2, "drug_strength": 2}, {"domain": 0, "drug_strength": 0}):
        assert load.load_vocabulary(loaded, str(tmp_path)) == expected
        assert loaded.read("rejected_vocabulary").count() == 1
    assert '"Drug' in {r.domain_name for r in loaded.read("domain").collect()}


def test_a_facility_load_that_broke_off_is_completed(spark, loaded, tmp_path, monkeypatch):
    from vitalspan.plans import dimensions

    path = str(tmp_path / "sites.csv")
    header = "CO_CNES;NO_RAZAO_SOCIAL;NO_LOGRADOURO;NU_ENDERECO;NO_COMPLEMENTO;NO_BAIRRO;CO_MUNICIPIO_GESTOR"
    header += ";CO_ESTADO_GESTOR;CO_CEP;NU_LATITUDE;NU_LONGITUDE;MORE"
    rows = [f"{i:07};SITE {i};RUA {i};1;;B;120013;12;1;-9.8;1;x" for i in range(3)]
    (tmp_path / "sites.csv").write_text("\n".join([header, *rows]) + "\n")
    right = dimensions.care_sites
    monkeypatch.setattr(dimensions, "care_sites", lambda k, start, place=1: right(k, start, place)
                        if not isinstance(place, int) else (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        load.load_facilities(loaded, path)
    monkeypatch.setattr(dimensions, "care_sites", right)
    assert load.load_facilities(loaded, path)["care_site"] == 3
    sites = loaded.read("care_site").where("care_site_name like 'SITE%'")
    places = loaded.read("location").where("address_1 like 'RUA%'")
    assert places.count() == 3
    pairs = sites.join(places, "location_id").select("care_site_source_value", "location_source_value")
    assert all(a == b for a, b in pairs.collect()) and pairs.count() == 3


def test_batches_of_few_files_have_the_keys_of_one(spark, store, loaded, tmp_path, monkeypatch):
    """Records of files, some dropped, are numbered the same in one batch and in many."""
    from vitalspan.plans.load import _batches
    from vitalspan.operators.keys import assign_keys_by_position
    from vitalspan.plans import load as loads

    path = str(tmp_path / "many")
    spark.range(0, 100, 1, 7).write.parquet(path)
    target = {"person": loads.Target("person_id", 1, None)}
    seen = []
    for limit, system in ((100, 1), (2, 2)):
        monkeypatch.setattr(loads, "FILES_PER_BATCH", limit)
        keys = {}
        batches = 0
        for batch in _batches(loaded, system, path, lambda scan: target):
            batches += 1
            kept = batch.scan.where("id % 3 <> 0")
            first = batch.keys["person"][0]
            keyed = assign_keys_by_position(kept, batch.scan, "k", first, batch.offsets)
            keys.update({r.id: r.k for r in keyed.select("id", "k").collect()})
        low = min(keys.values())
        seen.append({i: k - low for i, k in keys.items()})
        assert batches == (1 if limit == 100 else 4)
    assert seen[0] == seen[1] and len(seen[0]) == 66


def test_year_slices_do_not_depend_on_the_zone_of_the_process(spark):
    import os
    import time

    from vitalspan.functions.clean import in_year

    moments = ["2018-12-31 23:30:00", "2019-01-01 00:30:00", "2019-12-31 23:59:59", "2020-01-01 01:00:00"]
    frame = spark.createDataFrame([(m,) for m in moments], "m string").selectExpr(
        "m", "cast(m as timestamp) as t", "cast(m as timestamp_ntz) as n", "cast(m as date) as d"
    )
    before = os.environ.get("TZ")
    try:
        os.environ["TZ"] = "America/Sao_Paulo"
        time.tzset()
        for column in ("t", "n", "d"):
            got = {r.m for r in frame.where(in_year(F.col(column), 2019)).select("m").collect()}
            assert got == set(moments[1:3])
            start, end = dt.datetime(2019, 1, 1), dt.datetime(2020, 1, 1)
            got = summaries.time_filter(frame, column, start, end).select("m").collect()
            assert {r.m for r in got} == set(moments[1:3])
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()


def test_files_that_arrive_are_loaded_once(spark, loaded, tmp_path):
    folder = tmp_path / "arrivals"
    seen = []

    def arrive():
        def take(files):
            seen.extend(files)
            load.load_births(loaded, files)

        schema = ", ".join(f"{c} string" for c in records.BIRTH_COLUMNS)
        load_arrivals(
            spark, str(folder), schema, take, str(tmp_path / "checkpoint"), files_per_batch=1
        ).awaitTermination()

    birth_file(spark, folder / "2010" / "births_2010.parquet", 2)
    arrive()
    birth_file(spark, folder / "2011" / "births_2011.parquet", 3)
    arrive()
    arrive()
    assert len(seen) == len(set(seen)) == 2
    assert keys_of(loaded, "person", "person_id") == (5, 5)


def test_lineage_of_a_scan(spark, tmp_path):
    path = str(tmp_path / "l")
    spark.range(10).repartition(2).write.parquet(path)
    scan = with_lineage(spark.read.parquet(path))
    assert scan.select("source_file", "source_row").distinct().count() == 10
    named = {r.source_file.split(":")[1].lstrip("/") for r in scan.collect()}
    assert named == {file.split(":")[1].lstrip("/") for file in scan.inputFiles()}


def test_store_without_location(spark):
    store = TableStore(spark, "plain_store")
    store.replace(spark.range(1), "one")
    assert store.read("one").count() == 1
    spark.sql("DROP DATABASE plain_store CASCADE")


@pytest.mark.parametrize("limit", [0, 3, 1000])
def test_new_rows_are_the_same_with_and_without_filters(spark, store, monkeypatch, limit):
    """Held rows and repeats stay out whatever number of keys filters are made for."""
    from vitalspan import store as stores

    monkeypatch.setattr(stores, "FILTER_KEYS", limit)
    schema = "a long, b string, v int"
    held = [(1, "x", 0), (2, None, 0), (None, None, 0), (9, "y", 0)]
    store.create("kept", spark.createDataFrame([], schema).schema)
    assert store.append_new(spark.createDataFrame(held, schema), "kept", ["a", "b"]) == 4
    rows = [(1, "x", 5), (1, "z", 4), (1, "z", 3), (2, None, 1), (None, None, 2), (None, "x", 7),
            (3, "x", 1), (3, "x", None)]
    assert store.append_new(spark.createDataFrame(rows, schema), "kept", ["a", "b"]) == 3
    assert store.append_new(spark.createDataFrame(rows, schema), "kept", ["a", "b"]) == 0
    found = {tuple(r) for r in store.read("kept").collect()}
    assert found == {*held, (1, "z", 3), (None, "x", 7), (3, "x", 1)}
    plain = [(r, "p", 1) for r in (1, 1, 20, 9)]
    assert store.append_new(spark.createDataFrame(plain, schema), "kept", ["a", "b"]) == 3


def test_staged_lines_are_not_sorted_and_counted_once(spark, tmp_path, monkeypatch):
    from vitalspan.plans import vocabulary

    header, seen = "domain_id\tdomain_name\tdomain_concept_id\n", []
    (tmp_path / "DOMAIN.csv").write_text(header + "B\tb\t2\nA\ta\t1\nX\tx\tnone\n")
    frame = type(spark.range(0))
    right = frame.observe
    monkeypatch.setattr(frame, "observe", lambda df, *a: seen.append(1) or right(df, *a))
    staged = vocabulary.stage_vocabulary(spark, [str(tmp_path / "DOMAIN.csv")], "DOMAIN")
    assert len(seen) == 1 and not any("fits=" in f for f in staged.accepted.inputFiles())
    assert [b[1:3] for b in staged.bounds] == [("A", "B")]
    assert staged.accepted.count() == 2 and staged.rejected.count() == 1
    assert staged.rejected_bounds[1][1:] == ("_corrupt_record", "_corrupt_record", False)
