"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def build_session(app_name: str = "vitalspan", **overrides: str) -> SparkSession:
    """Session with the settings the library is written for: UTC, ANSI, AQE.

    The Java option lets HotSpot compile large methods. Spark's code for a projection of dozens of
    parsed columns is one, and stays interpreted, several times slower, without it.
    """
    conf = {
        "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **overrides,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# settings made for a while, and how many are at it
_HELD: dict[tuple[int, str], int] = {}
_ONE_AT_A_TIME = threading.Lock()


@contextlib.contextmanager
def default_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session while this lasts, unless the session has one of its own.

    Several threads may be at it; the last one takes the setting back.
    """
    held = (id(spark), key)
    with _ONE_AT_A_TIME:
        ours = held in _HELD or spark.conf.get(key, None) is None
        if ours:
            _HELD[held] = _HELD.get(held, 0) + 1
            spark.conf.set(key, value)
    try:
        yield
    finally:
        if ours:
            with _ONE_AT_A_TIME:
                _HELD[held] -= 1
                if not _HELD[held]:
                    del _HELD[held]
                    spark.conf.unset(key)


def delete_at_exit(spark: SparkSession, *paths: str) -> None:
    """Has written scratch folders deleted when the session's file system is closed."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables, below ``spark.checkpoint.dir``.

    The cluster names a shared folder there. Only a local master may fall back to a
    temporary folder, because elsewhere executors would not see the same one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="vitalspan-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
