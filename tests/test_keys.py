import pytest
from pyspark.sql import functions as F

from vitalspan.operators.keys import (
    assign_keys,
    assign_keys_by_position,
    child_key,
    file_offsets,
    next_key,
)
from vitalspan.sources.files import read_parquet, with_lineage


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_dense_and_the_same_for_any_partitioning(spark, partitions):
    frame = spark.range(1000).select((F.col("id") * 37 % 1000).alias("nk")).repartition(partitions)
    keyed = assign_keys(frame, "k", ["nk"], start=11)
    assert keyed.where(F.col("k") != F.col("nk") + 11).isEmpty()
    assert keyed.count() == 1000


def test_keys_do_not_drift_when_read_again(spark):
    keyed = assign_keys(spark.range(500).withColumn("x", F.rand(3)), "k", ["x", "id"])
    again = keyed.join(keyed.withColumnRenamed("k", "k2"), "id")
    assert again.where("k <> k2").isEmpty()


def test_empty_frame(spark):
    assert assign_keys(spark.range(0), "k", ["id"]).isEmpty()


def test_a_natural_key_with_many_copies_is_spread(spark, tmp_path):
    """A third of the rows share a key; with the lineage in the order no task gets them all."""
    path = str(tmp_path / "copies")
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("nk")
    spark.range(30000).select(hot).repartition(6).write.parquet(path)
    scan = with_lineage(read_parquet(spark, path))
    # without this, adaptive execution rightly joins such small partitions into one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = assign_keys(scan, "k", ["nk", "source_file", "source_row"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    totals = keyed.agg(F.count_distinct("k"), F.min("k"), F.max("k")).first()
    assert totals[:] == (30000, 1, 30000)
    sorted_files = [file for file in keyed.inputFiles() if "/keys-" in file]
    copies = [spark.read.parquet(file).where("nk = 0").count() for file in sorted_files]
    assert sum(copies) == 10000 and max(copies) < 9000


def test_keys_by_position(spark, tmp_path):
    path = str(tmp_path / "files")
    spark.range(0, 100, 1, 5).write.parquet(path)
    scan = with_lineage(read_parquet(spark, path))
    kept = scan.where("id % 10 <> 0")
    all_keys = assign_keys_by_position(scan, scan, "k", start=1000)
    totals = all_keys.agg(F.count_distinct("k"), F.min("k"), F.max("k")).first()
    assert totals[:] == (100, 1000, 1099)
    # a filtered record does not move the others
    assert (
        assign_keys_by_position(kept, scan, "k", start=1000)
        .select("k", "id")
        .exceptAll(all_keys.select("k", "id"))
        .isEmpty()
    )


def test_keys_by_position_with_stored_offsets(spark, tmp_path):
    path = str(tmp_path / "files")
    spark.range(0, 100, 1, 5).write.parquet(path)
    scan = with_lineage(read_parquet(spark, path))
    kept = scan.where("id % 3 <> 0")
    offsets = F.broadcast(file_offsets(scan).select("key_file", "rows_before"))
    whole = assign_keys_by_position(kept, scan, "k").select("k", "id")
    stored = assign_keys_by_position(kept, scan, "k", offsets=offsets).select("k", "id")
    assert whole.exceptAll(stored).isEmpty() and stored.count() == 66


def test_child_keys_are_dense(spark):
    parents = spark.range(5, 15).withColumn("position", F.explode(F.sequence(F.lit(0), F.lit(2))))
    children = parents.select(child_key(F.col("id"), 5, 3, F.col("position"), 100).alias("c"))
    assert sorted(r.c for r in children.collect()) == list(range(100, 130))


def test_next_key(spark):
    assert next_key(spark.range(0), "id") == 1
    assert next_key(spark.range(3, 8), "id") == 8
    assert next_key(spark.range(3, 8), "id", 100) == 100
    assert next_key(spark.range(3, 8), "id", 5) == 8


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from vitalspan import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        sparkContext = Context()

    with pytest.raises(ValueError):
        session.scratch_path(Session(), "x")


def test_keys_by_position_move_no_file_as_a_whole(spark, tmp_path, monkeypatch):
    from vitalspan.operators import keys

    path = str(tmp_path / "files")
    spark.range(0, 100, 1, 3).write.parquet(path)
    scan = with_lineage(read_parquet(spark, path))
    kept = scan.where("id % 3 <> 0")

    def keyed():
        return assign_keys_by_position(kept, scan, "k").select("k", "id")

    # even where Spark's own estimate would not broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = keyed()
        text = few._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
        monkeypatch.setattr(keys, "MAX_BROADCAST_FILES", 2)
        monkeypatch.setattr(keys, "BLOCK_ROWS", 7)
        many = keyed()
        text = many._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in text and "key_block" in text
        assert few.exceptAll(many).isEmpty() and few.count() == many.count() == 66
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
