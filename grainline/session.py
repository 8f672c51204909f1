"""Session settings the operators are written for, and folders of a session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def tuned_builder(master: str | None = None, **settings: str) -> SparkSession.Builder:
    """Session builder with the settings above; ``settings`` add to them."""
    builder = SparkSession.builder.appName("grainline")
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A local session without one uses its warehouse; on a cluster the setting is
    required, since a folder of one machine is no place for a table.
    """
    context = spark.sparkContext
    given = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not given and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (given or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def session_path(spark: SparkSession, name: str, of: str | None = None) -> str:
    """A folder where all executors reach it, removed when the session's JVM ends.

    It is a new one, or with ``of`` the one that belongs to this session and text.
    """
    own = uuid.uuid4().hex
    if of is not None:
        own = uuid.uuid5(uuid.NAMESPACE_URL, f"{spark.sparkContext.applicationId} {of}").hex
    path = f"{shared_root(spark)}/{name}-{own}"
    place, system = _place(spark, path)
    system.deleteOnExit(place)
    return path


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a folder and read back, which cuts its plan there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that is no longer read."""
    place, system = _place(spark, path)
    system.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
