"""Standard vocabulary files to tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalspan.functions.clean import VOCABULARY_DATE, plain_code, source_date
from vitalspan.operators.key_filter import Bounds, observe_bounds, observed_bounds
from vitalspan.operators.lookup import attach
from vitalspan.schemas import required_columns, table_schema
from vitalspan.session import delete_at_exit, scratch_path
from vitalspan.sources.files import CORRUPT, read_typed_delimited

# fixed values: the files of a vocabulary download, each named after its table, and what
# identifies a row
FILES = {
    "CONCEPT": ["concept_id"],
    "CONCEPT_ANCESTOR": ["ancestor_concept_id", "descendant_concept_id"],
    "CONCEPT_CLASS": ["concept_class_id"],
    "CONCEPT_RELATIONSHIP": ["concept_id_1", "concept_id_2", "relationship_id"],
    "CONCEPT_SYNONYM": ["concept_id", "concept_synonym_name", "language_concept_id"],
    "DOMAIN": ["domain_id"],
    "DRUG_STRENGTH": ["drug_concept_id", "ingredient_concept_id", "valid_start_date"],
    "RELATIONSHIP": ["relationship_id"],
    "VOCABULARY": ["vocabulary_id"],
}


def file_schema(name: str) -> T.StructType:
    """Schema of a file: that of its table, with dates as the digits they are written in."""
    text = T.StringType()
    return T.StructType(
        [
            T.StructField(f.name, text if isinstance(f.dataType, T.TimestampType) else f.dataType)
            for f in table_schema(name.lower())
        ]
    )


def parsed_lines(spark: SparkSession, paths: str | Sequence[str], name: str) -> DataFrame:
    """Every line of the files of one table, in its shape, with ``line`` and ``missing_columns``.

    Both are null where the line fits. The download does not quote, so a quote is a character like
    others.
    """
    schema = table_schema(name.lower())
    raw = read_typed_delimited(spark, paths, file_schema(name), quote="")

    def value(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.TimestampType):
            return source_date(F.col(field.name), VOCABULARY_DATE)
        return F.col(field.name)

    typed = raw.select(
        *[value(f).cast(f.dataType).alias(f.name) for f in schema], F.col(CORRUPT).alias(CORRUPT)
    )
    lacking = F.concat_ws(
        ",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required_columns(schema)]
    )
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT)).when(lacking != "", lacking)
    record = F.to_json(F.struct(*schema.names))
    return typed.select(
        *schema.names,
        F.when(reason.isNotNull(), F.coalesce(F.col(CORRUPT), record)).alias("line"),
        reason.alias("missing_columns"),
    )


def read_vocabulary(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows of one file of a folder in the shape of its table, and the lines that do not fit."""
    lines = parsed_lines(spark, f"{folder}/{name}.csv", name)
    accepted = lines.where("missing_columns IS NULL").select(*table_schema(name.lower()).names)
    return accepted, lines.where("missing_columns IS NOT NULL").select("line", "missing_columns")


class Staged(NamedTuple):
    """The lines of a table's files, parsed once, and the key bounds of those that fit."""

    accepted: DataFrame
    bounds: list[Bounds]
    rejected: DataFrame
    rejected_bounds: list[Bounds]


def stage_vocabulary(spark: SparkSession, paths: Sequence[str], name: str) -> Staged:
    """Parses each line of the files once and writes it with its outcome.

    What is read after that is Parquet, only the columns asked for. Rows and key bounds of both
    outcomes are counted during the write, in one pass. The outcome is a column, as lines would be
    sorted by a partition.
    """
    lines = parsed_lines(spark, paths, name).withColumn("fits", F.col("missing_columns").isNull())
    key, aside = FILES[name], ["line", "missing_columns"]
    path, counted = scratch_path(spark, "vocabulary"), Observation()
    # bounds of keys of lines that fit, and of lines that don't
    only = lines.select(
        "*", *[F.when(F.col("fits"), F.col(c)).alias(f"key_{c}") for c in key]
    )
    bounded = [f"key_{c}" for c in key] + aside
    observed = observe_bounds(only, counted, bounded, F.count_if("fits").alias("fitting"))
    observed.drop(*[f"key_{c}" for c in key]).write.parquet(path)
    delete_at_exit(spark, path)
    stored = spark.read.schema(lines.schema).parquet(path)
    total, found = observed_bounds(counted, bounded)
    bounds, rejected_bounds = found[: len(key)], found[len(key) :]
    accepted_rows = counted.get["fitting"]
    # keys of the other lines were left out as nulls; a row that fits lacks none of its key
    bounds = [Bounds(c, b.low, b.high, False) for c, b in zip(key, bounds)]
    rejected_bounds = [b._replace(nulls=False) for b in rejected_bounds]
    return Staged(
        stored.where("fits").select(*table_schema(name.lower()).names),
        bounds if accepted_rows else [],
        stored.where("NOT fits").select(F.lit(name.lower()).alias("table_name"), *aside),
        rejected_bounds if total > accepted_rows else [],
    )


def paths_in(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """The paths of the vocabulary files in a folder or below it. Names only; no content is read."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(
            # a file, or a folder of that name with its parts
            F.regexp_extract("path", r"^(.*/([A-Z_]+)\.csv)(/[^/]*)?$", 2).alias("name"),
            F.regexp_extract("path", r"^(.*/([A-Z_]+)\.csv)(/[^/]*)?$", 1).alias("path"),
        )
        .where(F.col("name").isin(*FILES))
        .distinct()
    )
    found: dict[str, list[str]] = {}
    for row in listing.collect():
        found.setdefault(row.name, []).append(row.path)
    return {name: sorted(found[name]) for name in FILES if name in found}


def files_in(spark: SparkSession, folder: str) -> list[str]:
    """The names of the vocabulary files in a folder or below it."""
    return list(paths_in(spark, folder))


def code_to_concept(
    records: DataFrame, code: str, concept: DataFrame, vocabulary_id: str | None = None
) -> DataFrame:
    """Adds ``concept_id`` of a source code, dots ignored; unknown codes keep a null.

    One concept per code (the lowest), so no record is multiplied.
    """
    if vocabulary_id is not None:
        concept = concept.where(F.col("vocabulary_id") == vocabulary_id)
    known = plain_code(F.col("concept_code"))
    return attach(
        records, plain_code(F.col(code)), concept, known, {"concept_id": "concept_id"}
    )
