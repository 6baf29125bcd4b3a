"""Tables of the model in a catalog database."""

from __future__ import annotations

import functools
import logging
import os
import re
import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from vitalspan.layouts import LAYOUTS, MOMENTS, WRITING, clustered_ddl
from vitalspan.operators.contract import enforce_required
from vitalspan.operators.key_filter import (
    FILTER_KEYS,
    Bounds,
    may_hold,
    observe_bounds,
    observed_bounds,
    overlaps,
    within,
)
from vitalspan.operators.keys import next_key
from vitalspan.schemas import TABLES
from vitalspan.session import default_setting, delete_at_exit, scratch_path
from vitalspan.sources.files import read_text

log = logging.getLogger(__name__)

#: Key bounds of the files that each append of new rows wrote.
HELD = "held_keys"
HELD_SCHEMA = (
    "table_name string, batch string, files array<string>, column_name string, low string, "
    "high string, nulls boolean"
)


class TableStore:
    """Reads, appends, replaces and publishes the tables of one database (Parquet)."""

    def __init__(self, spark: SparkSession, database: str = "cdm", location: str | None = None):
        self.spark = spark
        self.database = database
        self._one_writer = threading.Lock()
        where = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    # lifecycle

    def create(self, table: str, schema: T.StructType) -> None:
        """An empty table, unless it exists."""
        if not self.spark.catalog.tableExists(self.name(table)):
            self.spark.catalog.createTable(
                self.name(table), source="parquet", schema=schema, **WRITING
            )

    def create_tables(self, buckets: int | None = None) -> None:
        """All registered tables.

        With ``buckets`` the event tables are clustered: partitioned by the year of the event, with
        so many buckets of persons in each. Choose it for the size of a bucket of a year, some
        hundred MB; all event tables share it, or their joins would shuffle.
        """
        for table, schema in TABLES.items():
            if buckets and table in LAYOUTS:
                self.spark.sql(clustered_ddl(self.name(table), schema, LAYOUTS[table], buckets))
            else:
                self.create(table, schema)

    def drop_tables(self) -> None:
        """All registered tables."""
        for table in TABLES:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def run_script(self, path: str) -> list[tuple[str, str | None]]:
        """Runs the statements of a SQL file in turn, over errors too.

        Returns each statement with its error or None. Statements end with ``;``, which may stand
        in quotes and comments.
        """
        text = "\n".join(row.value for row in read_text(self.spark, path).collect())
        outcome = []
        for statement in split_statements(text):
            try:
                self.spark.sql(statement)
                outcome.append((statement, None))
            except Exception as error:  # noqa: BLE001 - the script goes on, the error is reported
                log.error("statement failed: %s", error)
                outcome.append((statement, str(error)))
        return outcome

    # rows

    def read(self, table: str) -> DataFrame:
        """The rows of a table, without the column that a clustered one is partitioned by."""
        stored = self.scan(table)
        return stored.drop(LAYOUTS[table].partition) if table in LAYOUTS else stored

    def scan(self, table: str) -> DataFrame:
        """The rows of a table as they are stored."""
        return self.spark.read.table(self.name(table))

    def of_years(self, table: str, first: int, last: int) -> DataFrame:
        """The rows of a clustered table whose event is in these years; other partitions stay shut.

        Of a table that isn't clustered, all rows: whoever reads it has to look at the events too.
        """
        stored = self.scan(table)
        partition = LAYOUTS[table].partition
        if partition not in stored.columns:
            return stored
        return stored.where(F.col(partition).between(first, last)).drop(partition)

    def next_key(self, table: str, id_col: str, floor: int = 1) -> int:
        """The first free key of a table at or above ``floor``."""
        return next_key(self.read(table), id_col, floor)

    def append(self, df: DataFrame, table: str) -> int:
        """Appends by column name and returns the number of rows, counted during the write.

        Nulls in required columns of a registered table fail the write as a whole.
        """
        counter = Observation()
        self._write(df.observe(counter, F.count(F.lit(1)).alias("rows")), table)
        return counter.get["rows"]

    def _write(self, df: DataFrame, table: str) -> None:
        if table in TABLES:
            df = enforce_required(df, TABLES[table])
        if table in LAYOUTS:
            layout, columns = LAYOUTS[table], self.scan(table).columns
            if layout.partition in columns:
                # the buckets' own hash, so a bucket of a year is one file; the years are dealt too,
                # or a task would sort a bucket of all years
                rows = df.withColumn(layout.partition, F.expr(layout.value)).select(*columns)
                bucket = F.pmod(F.hash(layout.bucket), F.lit(self._buckets(table)))
                rows = rows.repartition(layout.partition, bucket)
                with default_setting(self.spark, *MOMENTS):
                    rows.write.insertInto(self.name(table))
                return
        with default_setting(self.spark, *MOMENTS):
            df.write.mode("append").format("parquet").options(**WRITING).saveAsTable(self.name(table))

    def append_new(
        self, df: DataFrame, table: str, key: list[str], between: tuple[int, int] | None = None
    ) -> int:
        """Appends the rows whose key the table does not hold yet.

        Nulls in keys are equal to each other. Of arriving rows with the same key one comes in.
        ``between`` promises that the (single-column) key of ``df`` is unique and within that
        half-open range. Only such target rows are read then, and parquet statistics skip other
        files. Without it the arriving rows are written to the scratch folder first, which gives
        the bounds of their keys.
        """
        if between is None:
            return self.append_staged(*self.stage(df, table, key), table, key)
        held = self.read(table).select(*key)
        held = held.where((F.col(key[0]) >= between[0]) & (F.col(key[0]) < between[1]))
        # stored keys are far smaller than they are in memory, so they are not to be broadcast
        return self.append(new_rows(df, held.hint("merge"), key), table)

    def stage(self, df: DataFrame, table: str, key: list[str]) -> tuple[DataFrame, list[Bounds]]:
        """``df`` in the types of the table, written to the scratch folder, and its key bounds."""
        columns = [f for f in self.read(table).schema if f.name in df.columns]
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns])
        path, counter = scratch_path(self.spark, "arriving"), Observation()
        observe_bounds(typed, counter, key).write.parquet(path)
        delete_at_exit(self.spark, path)
        rows, bounds = observed_bounds(counter, key)
        return self.spark.read.schema(typed.schema).parquet(path), bounds if rows else []

    def append_staged(
        self, arriving: DataFrame, bounds: list[Bounds], table: str, key: list[str]
    ) -> int:
        """Appends the rows of a written frame whose key the table does not hold yet.

        Held rows are looked for only in files whose stored key bounds meet those of the arriving
        rows, and of these files only rows that a filter of the arriving keys lets through are
        moved. Arriving rows are moved only where their key may come twice, or may be held; those
        that may be held are compared with the held ones first. A filter of so many keys that it
        would let most through isn't made.
        """
        if not bounds:
            return 0
        before = self._files(table)
        files = self.files_that_may_hold(before, bounds, table)
        apart, parts = arriving, []
        if files:
            schema = self.read(table).schema
            stored = self.spark.read.schema(schema).parquet(*files)
            held = stored.where(within(bounds, schema)).select(*key)
            few, few_held = arriving.count() <= FILTER_KEYS, stored.count() <= FILTER_KEYS
            if few:
                held = may_hold(held, arriving, key, "key_maybe").where("key_maybe").drop("key_maybe")
            near, apart = arriving, None
            if few or few_held:
                marked = may_hold(arriving, held, key, "key_near")
                near, apart = (marked.where(c).drop("key_near") for c in ("key_near", "NOT key_near"))
            if not few_held:
                # stored keys are far smaller than they are in memory
                held = held.hint("merge")
            nulls = any(bound.nulls for bound in bounds)
            parts.append(one_per_key(new_rows(near, held, key, nulls), key))
        if apart is not None:
            hashes = apart.groupBy(F.xxhash64(*key).alias("key_hash"))
            twice = hashes.agg(F.count(F.lit(1)).alias("key_rows")).where("key_rows > 1")
            marked = may_hold(apart, twice, key, "key_suspect", "key_hash")
            parts.append(marked.where("NOT key_suspect").drop("key_suspect"))
            parts.append(one_per_key(marked.where("key_suspect").drop("key_suspect"), key))
        new = functools.reduce(DataFrame.unionByName, parts)
        counter = Observation()
        self._write(observe_bounds(new, counter, key), table)
        rows, written = observed_bounds(counter, key)
        if rows:
            self._remember(table, sorted(self._files(table) - before), written)
        return rows

    def _buckets(self, table: str) -> int:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.name(table)}").collect()
        return next(int(row.data_type) for row in rows if row.col_name == "Num Buckets")

    def _files(self, table: str) -> set[str]:
        """The files of a table, as Spark's own listing has them."""
        return set(self.read(table).inputFiles())

    def files_that_may_hold(
        self, files: set[str], bounds: list[Bounds], table: str
    ) -> list[str]:
        """Files without stored key bounds, or with bounds that meet the given ones."""
        if not files or not self.spark.catalog.tableExists(self.name(HELD)):
            return sorted(files)
        schema = self.read(table).schema
        meets = F.lit(True)
        for bound in bounds:
            own = F.col("column_name") == bound.column
            meets &= ~own | overlaps(bound, schema[bound.column].dataType)
        apart = (
            self.read(HELD)
            .where((F.col("table_name") == table) & F.col("column_name").isin(*[b.column for b in bounds]))
            .where(~meets)
            .select(F.explode("files").alias("file"))
        )
        given = self.spark.createDataFrame([(name,) for name in sorted(files)], "file string")
        return sorted(row.file for row in given.join(apart, "file", "left_anti").collect())

    def _remember(self, table: str, files: list[str], bounds: list[Bounds]) -> None:
        batch = uuid.uuid4().hex
        rows = [(table, batch, files, *bound) for bound in bounds]
        # tables may be appended to at the same time, but this one by one writer only
        with self._one_writer:
            self.create(HELD, T.StructType.fromDDL(HELD_SCHEMA))
            self._write(self.spark.createDataFrame(rows, HELD_SCHEMA).coalesce(1), HELD)

    def replace(self, df: DataFrame, table: str) -> None:
        """Replaces the contents of a table."""
        df.write.mode("overwrite").format("parquet").saveAsTable(self.name(table))

    def publish(
        self, df: DataFrame, table: str, location: str, if_exists: str = "fail"
    ) -> DataFrame:
        """Writes a result as an external Parquet table: ``fail`` or ``replace`` if it exists.

        Each publication has a folder of its own below ``location``. A replaced table is switched
        over when the new folder is complete, so a result may read the table it replaces, and a
        failed write leaves it as it was.
        """
        if if_exists not in ("fail", "replace"):
            raise ValueError(f"if_exists must be 'fail' or 'replace', not {if_exists!r}")
        name, spark = self.name(table), self.spark
        exists = spark.catalog.tableExists(name)
        if exists and if_exists == "fail":
            raise AnalysisException(f"table {name} already exists")
        folder = f"{location.rstrip('/')}/{uuid.uuid4().hex}"
        df.write.format("parquet").save(folder)
        before = {os.path.dirname(f) for f in spark.read.table(name).inputFiles()} if exists else ()
        if exists:
            spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, folder, source="parquet", schema=df.schema)
        for old in before:
            path = spark._jvm.org.apache.hadoop.fs.Path(old)
            files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            # only what an earlier publication wrote below this location
            below = files.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(location))
            if path.getParent().equals(below):
                files.delete(path, True)
        return spark.read.table(name)


# quoted text, comments, the end of a statement
_MARKS = re.compile(
    r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|(?P<comment>--[^\n]*|/\*.*?\*/)|(?P<end>;)""",
    re.DOTALL,
)


def split_statements(text: str) -> list[str]:
    """The statements of a script, without comments."""
    statements, current, at = [], "", 0
    for mark in _MARKS.finditer(text):
        current += text[at : mark.start()]
        at = mark.end()
        if mark["end"]:
            statements.append(current)
            current = ""
        else:
            current += " " if mark["comment"] else mark[0]
    statements.append(current + text[at:])
    return [s.strip() for s in statements if s.strip()]


def one_per_key(df: DataFrame, key: list[str]) -> DataFrame:
    """One row of each key, the least of those that share it."""
    rest = [F.struct(F.col(c).isNull(), F.col(c)).alias(c) for c in df.columns if c not in key]
    least = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("least")) if rest else df.distinct()
    columns = [F.col(c) if c in key else F.col(f"least.{c}.{c}").alias(c) for c in df.columns]
    return least.select(*columns) if rest else least


def new_rows(df: DataFrame, held: DataFrame, key: list[str], nulls: bool = True) -> DataFrame:
    """Rows of ``df`` whose key is not in ``held``; nulls are equal to each other.

    ``nulls`` tells whether a key of ``df`` may have some; without, less is compared and moved.
    """
    known = held.select(*[F.col(c).alias(f"held_{c}") for c in key])
    same = [
        F.col(c).eqNullSafe(F.col(f"held_{c}")) if nulls else F.col(c) == F.col(f"held_{c}")
        for c in key
    ]
    return df.join(known, functools.reduce(Column.__and__, same), "left_anti")


def export_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Replaces a database table with the rows of ``df``, one connection per partition."""
    df.write.jdbc(url=url, table=table, mode="overwrite", properties=properties)
