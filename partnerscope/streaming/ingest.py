"""Feeds that grow: every landed file is cleaned and added once, to a typed table with ids.

The stream's checkpoint remembers the files done, and has an identity that lasts: the query's.
A batch's rows are a partition of the table, named by that identity and the batch's number. So a
batch that runs again after a failure replaces its own rows, and nothing else does: other feeds,
or the same feed taken anew with another checkpoint, have partitions of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partnerscope.operators.tables import HIGH, append_numbered, append_rows, batch_start, create_database
from partnerscope.session import stage, unstage
from partnerscope.sources.feeds import ID, LoadColumn, sheet_frame
from partnerscope.sources.workbook import WORKBOOK_FILES, workbook_rows

FEED, BATCH = "feed", "batch_no"
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

#: The fingerprint of what a row or a file holds.
PRINT = "_fingerprint"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Adds a cleaned batch to a table in a partition, ids counting on from a number; returns its rows.
Adder = Callable[[DataFrame, str, str, str, int], int]


def landed_rows(spark: SparkSession, path: str, schema: T.StructType | str, file_format: str = "parquet", **options) -> DataFrame:
    """Rows of the files under a path, as they land."""
    return spark.readStream.format(file_format).schema(schema).options(**options).load(path)


def landed_sheets(spark: SparkSession, path: str, files_per_batch: int = 1000, distinct: bool = False) -> DataFrame:
    """Sheet rows of the workbooks in a folder, as they land.

    With ``distinct`` a workbook whose bytes came before, under whatever name, has no rows.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", WORKBOOK_FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
    return workbook_rows(distinct_by(files, F.col("content")) if distinct else files)


def distinct_by(stream: DataFrame, content: Column) -> DataFrame:
    """One row for each content that the stream has ever had.

    The fingerprints (SHA-256) seen so far are the stream's state, dealt by hash over as many
    stores as the session has shuffle partitions when the checkpoint is made. A batch touches
    only the keys it brings. State grows with the distinct contents, 32 bytes each.
    """
    printed = stream.withColumn(PRINT, F.unhex(F.sha2(content, 256)))
    return printed.dropDuplicates([PRINT]).drop(PRINT)


def distinct_rows(stream: DataFrame) -> DataFrame:
    """Rows whose values haven't come before, all columns taken together; NULL is a value."""
    values = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    return distinct_by(stream, F.to_json(values, {"ignoreNullFields": "false"}).cast("binary"))


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """State stores that need not fit in memory, where the session names no store of its own."""
    named = spark.conf.get(STATE_STORE, None)
    usual = named is None or named.endswith("HDFSBackedStateStoreProvider")
    if usual:
        spark.conf.set(STATE_STORE, STATE_ON_DISK)
    try:
        yield
    finally:
        if usual:
            spark.conf.unset(STATE_STORE) if named is None else spark.conf.set(STATE_STORE, named)


def create_target(spark: SparkSession, database: str, table: str, columns: list[tuple[str, str]]) -> None:
    """The typed table that feeds are added to; one that is there stays as it is."""
    create_database(spark, database)
    listed = ", ".join([f"`{ID}` bigint"] + [f"`{name}` {kind}" for name, kind in columns])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({listed}, `{FEED}` string, `{BATCH}` bigint) "
        f"USING parquet PARTITIONED BY (`{FEED}`, `{BATCH}`) TBLPROPERTIES ('{HIGH}' = '0')"
    )


def _append(batch: DataFrame, database: str, table: str, partition: str, start: int) -> int:
    return append_rows(batch.sparkSession, batch, database, table, partition, start)


def _append_sheets(batch: DataFrame, database: str, table: str, partition: str, start: int) -> int:
    return append_numbered(batch.sparkSession, batch, "path", "row_no", database, table, partition, start)


def _append_staged_sheets(batch: DataFrame, database: str, table: str, partition: str, start: int) -> int:
    """A batch with state is computed once: counting and loading both read what it gave."""
    spark = batch.sparkSession
    staged = stage(batch, "sheets")
    try:
        return _append_sheets(spark.table(staged), database, table, partition, start)
    finally:
        unstage(spark, staged)


def ingest_new(
    stream: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    database: str,
    table: str,
    checkpoint: str,
    append: Adder = _append,
) -> int:
    """Adds all files not yet taken and stops; returns the number of rows added.

    One load into a table at a time, as ids go on from the highest one there.
    """
    added = 0
    identity: list[str] = []
    started = Event()

    def add(batch: DataFrame, number: int) -> None:
        nonlocal added
        started.wait()
        spark, feed = batch.sparkSession, identity[0]
        others = f"NOT ({FEED} = '{feed}' AND {BATCH} = {number})"
        start = batch_start(spark, database, table, feed, number, others)
        added += append(clean(batch), database, table, f"`{FEED}` = '{feed}', `{BATCH}` = {number}", start)

    query = (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    identity.append(query.id)
    started.set()
    query.awaitTermination()
    return added


def ingest_distinct(
    stream: DataFrame, clean: Callable[[DataFrame], DataFrame], database: str, table: str, checkpoint: str
) -> int:
    """Adds the rows of landed files that none before had; returns the number of rows added.

    A file that lands again under another name adds nothing, one that also has new rows adds only
    those, and rows that repeat within a file are one. That holds for all that went through
    the checkpoint, in this run or one before. A batch that runs again meets the state it met
    the first time, so it adds the same rows.
    """
    with state_on_disk(stream.sparkSession):
        return ingest_new(distinct_rows(stream), clean, database, table, checkpoint)


def ingested(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Everything added so far, with its ids."""
    return spark.table(f"`{database}`.`{table}`").drop(FEED, BATCH)


def ingest_sheets(
    spark: SparkSession, landing: str, layout: list[LoadColumn], database: str, table: str, checkpoint: str, distinct: bool = False
) -> int:
    """Workbooks of a feed with known columns, each loaded once; returns the rows added.

    With ``distinct`` a workbook that lands again under another name adds nothing. A checkpoint
    is made with it or without it, and stays so.
    """
    create_target(spark, database, table, [(c.name, c.type) for c in layout])
    with state_on_disk(spark):
        return ingest_new(
            landed_sheets(spark, landing, distinct=distinct),
            lambda batch: sheet_frame(batch, layout),
            database,
            table,
            checkpoint,
            _append_staged_sheets if distinct else _append_sheets,
        )
