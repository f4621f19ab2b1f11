"""Session settings and the shared work folder."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

WORK_DATABASE = "partnerscope_work"


def local_session(cores: str | int = "*", partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter sets these."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("partnerscope")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster; else one in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/shared").rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """The frame computed once and held in the shared folder, for what the tables it reads outlive it.

    Spark frees it with the frame where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(df.sparkSession)}/partnerscope/checkpoints")
    return df.checkpoint()


def work_database(spark: SparkSession) -> str:
    """The database of staged tables: one for each shared folder, as a database keeps its place."""
    folder = f"{shared_folder(spark)}/partnerscope"
    name = f"{WORK_DATABASE}_{hashlib.sha256(folder.encode()).hexdigest()[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder}/{name}'")
    return name


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/partnerscope/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str) -> str:
    """Writes a frame to a table of its own in the shared folder; returns the table's name.

    Cuts the lineage: what follows reads files that stay the same, so a lost executor
    or a second use does not run the steps before again. ``unstage`` frees the space.
    """
    name = f"{work_database(df.sparkSession)}.{purpose}_{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(name)
    return name


def unstage(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def new_database(spark: SparkSession, purpose: str) -> str:
    """A database of its own, stored in the shared folder; ``drop_database`` frees it."""
    name = f"{purpose}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{new_folder(spark, name)}'")
    return name


def drop_database(spark: SparkSession, name: str) -> None:
    """The database with all its tables."""
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


@contextmanager
def passing_database(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A database that goes with the block, also if it fails."""
    name = new_database(spark, purpose)
    try:
        yield name
    finally:
        drop_database(spark, name)


@contextmanager
def passing_folder(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A folder in the shared store that goes with the block, also if it fails."""
    place = new_folder(spark, purpose)
    try:
        yield place
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
