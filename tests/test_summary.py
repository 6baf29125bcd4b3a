"""The summary that the load queries give of a store."""

import datetime as dt
import os

from fixtures import queries
from test_explain import plan


def tables(spark, store):
    store.create_tables()
    day = dt.datetime(1999, 5, 7, 11, 30)
    person = "person_id long, birth_timestamp timestamp"
    rows = [(1, day), (2, day + dt.timedelta(days=1)), (3, None)]
    spark.createDataFrame(rows, person).write.saveAsTable(store.name("person"), mode="overwrite")
    # keys twice, missing, negative and far apart; a person twice, unknown, and of another day
    fact = "observation_id long, person_id long, observation_date timestamp"
    rows = [(0, 1, day), (0, 1, day), (None, 1, day), (-1, 2, day), (63, 3, day), (1 << 50, 9, day)]
    spark.createDataFrame(rows, fact).write.saveAsTable(
        store.name("observation"), mode="overwrite"
    )
    return store.read("person").select("person_id", "birth_timestamp")


def summary(store, event, *names):
    keys = {
        "observation": ("observation_id", "observation_date"),
        "measurement": ("measurement_id", "measurement_date"),
    }
    return queries._load_summary(store, {name: keys[name] for name in names}, event)


def test_summary_counts_rows_keys_and_days(spark, store):
    event = tables(spark, store)
    found = {row.table_name: row[1:] for row in summary(store, event, "observation", "measurement").collect()}
    first = (dt.date(1999, 5, 7) - dt.date(1970, 1, 1)).days
    assert found == {"observation": (6, 4, 3, 4 * first + 1), "measurement": (0, 0, 0, None)}


def test_summary_broadcasts_no_events(spark, store):
    event = tables(spark, store)
    text = plan(summary(store, event, "observation"))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_summary_of_persons_with_several_days(spark, store):
    """Rows of a person whose days differ are compared one by one; a person's events all count."""
    store.create_tables()
    day = dt.datetime(1999, 5, 7, 11, 30)
    later, person = day + dt.timedelta(days=1), "person_id long, birth_timestamp timestamp"
    events = [(1, day), (2, day), (2, later), (3, day), (None, day)]
    spark.createDataFrame(events, person).write.saveAsTable(store.name("person"), mode="overwrite")
    fact = "observation_id long, person_id long, observation_date timestamp"
    rows = [(1, day), (1, later), (1, None), (1, day), (2, day), (3, later), (3, None), (4, day),
            (4, later), (None, day), (None, later)]
    numbered = [(number, *row) for number, row in enumerate(rows)]
    spark.createDataFrame(numbered, fact).write.saveAsTable(
        store.name("observation"), mode="overwrite"
    )
    found = summary(store, store.read("person").select("person_id", "birth_timestamp"), "observation")
    first = (day.date() - dt.date(1970, 1, 1)).days
    assert [tuple(row) for row in found.collect()] == [("observation", 12, 11, 3, 8 * first + 1)]


def test_summary_exchanges_the_rows_of_a_table_once(spark, store):
    event = tables(spark, store)
    text = plan(summary(store, event, "observation"))
    assert not [line for line in text.splitlines() if "Exchange" in line and "own_day" in line.split("[plan_id")[0]]


def test_summary_takes_persons_once(spark, store):
    """What is told of all persons of a table is one subquery, whatever uses it."""
    event = tables(spark, store)
    found = summary(store, event, "observation")
    assert found.collect()[0].rows == 6
    assert "ReusedSubquery" in plan(found)


def test_tables_are_written_small(spark, store, tmp_path):
    """Keys that count up take no room worth mentioning."""
    rows = spark.range(0, 200_000, 1, 1).selectExpr("id as k", "id div 10 as person")
    store.create("counted", rows.schema)
    store.append(rows, "counted")
    files = [f.removeprefix("file:") for f in store.read("counted").inputFiles()]
    assert sum(os.path.getsize(f) for f in files) < 200_000 / 2
    assert store.read("counted").distinct().count() == 200_000
