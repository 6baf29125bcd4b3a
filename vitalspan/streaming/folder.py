"""Folders that files keep arriving in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def load_arrivals(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    load: Callable[[list[str]], object],
    checkpoint: str,
    pattern: str = "*.parquet",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Hands the files that are new since the last run to ``load`` and stops.

    The checkpoint remembers which files were handed over. A batch that breaks off is handed
    over again with the same files, so ``load`` must tolerate that, as the loads of this library
    do. Only file names come to the driver, at most ``files_per_batch`` at a time.
    """

    def handle(batch: DataFrame, _batch_id: int) -> None:
        names = batch.select("source_file").distinct().orderBy("source_file")
        files = [row.source_file for row in names.collect()]
        if files:
            load(files)

    arrivals = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
        .select(F.col("_metadata.file_path").alias("source_file"))
    )
    return (
        arrivals.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
