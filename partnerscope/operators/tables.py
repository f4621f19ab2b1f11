"""Databases and tables of loaded feeds: create, append with ids, drop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from partnerscope.session import stage, unstage
from partnerscope.sources.feeds import ID, LoadColumn, frame_to_load

FILE, PLACE = "_file", "_place"
#: Properties of a table, its load journal: the highest id, the load that has begun and not ended,
#: and for each feed its last batch with the id before it.
HIGH, OPEN, BATCHES = "partnerscope.high_id", "partnerscope.open_load", "partnerscope.batch."


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def create_table(spark: SparkSession, database: str, table: str, layout: Sequence[LoadColumn]) -> None:
    """A table with an id and the given columns; one that is there stays as it is."""
    create_database(spark, database)
    columns = ", ".join([f"`{ID}` bigint"] + [f"`{c.name}` {c.type}" for c in layout])
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({columns}) USING parquet TBLPROPERTIES ('{HIGH}' = '0')")


def journal(spark: SparkSession, database: str, table: str) -> dict[str, str]:
    """What the table's journal says."""
    rows = spark.sql(f"SHOW TBLPROPERTIES `{database}`.`{table}`").collect()
    return {r["key"]: r["value"] for r in rows if r["key"].startswith("partnerscope.")}


def note(spark: SparkSession, database: str, table: str, **entries: str) -> None:
    """Writes entries to the journal, all in one change of the catalog."""
    values = ", ".join(f"'{key}' = '{value}'" for key, value in entries.items())
    spark.sql(f"ALTER TABLE `{database}`.`{table}` SET TBLPROPERTIES ({values})")


def high_id(spark: SparkSession, database: str, table: str, where: str = "true") -> int:
    """The highest id: from the journal, so that no load reads the rows of those before it.

    The ids are looked at only where the journal can't tell: the table has none, or the last
    load ended without a word, so that its rows may or may not be there.
    """
    said = journal(spark, database, table)
    if HIGH in said and not said.get(OPEN):
        return int(said[HIGH])
    return last_id(spark, database, table, where)


def batch_start(spark: SparkSession, database: str, table: str, feed: str, batch: int, where: str) -> int:
    """The id before a feed's batch: for one that runs again the same as before, else the highest.

    ``where`` tells the rows of all other batches, for a journal that can't tell.
    """
    said = journal(spark, database, table)
    last, _, start = said.get(BATCHES + feed, "").partition(":")
    if not said.get(OPEN) and last == str(batch):
        return int(start)
    found = high_id(spark, database, table, where)
    note(spark, database, table, **{BATCHES + feed: f"{batch}:{found}"})
    return found


def row_offsets(counts: DataFrame) -> DataFrame:
    """``source`` and ``_offset``, the rows of all sources before it, from ``source`` and ``_rows``.

    Sources are dealt into ranges, each summed up by a task of its own; only the sums of the
    ranges, as many as the session has shuffle partitions, meet in one.
    """
    in_range = Window.partitionBy("_range").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    of_ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy("_range").agg(F.sum("_rows").alias("_sum"))
    before = sums.select("_range", F.coalesce(F.sum("_sum").over(of_ranges), F.lit(0)).alias("_before"))
    within = counts.select("source", "_range", F.coalesce(F.sum("_rows").over(in_range), F.lit(0)).alias("_within"))
    return within.join(before, "_range").select("source", (F.col("_before") + F.col("_within")).alias("_offset"))


def append_numbered(
    spark: SparkSession, df: DataFrame, source: str, place: str, database: str, table: str, partition: str = "", start: int | None = None
) -> int:
    """Appends rows with ids by their ``source`` and ``place``; returns how many.

    ``place`` is the row's number from 1 within its ``source`` (a workbook, a file). An id is
    the rows of the sources before plus the place, so rows are neither sorted nor moved, there
    are no gaps, and a task that runs again gives the same ids. The rows of each source are
    counted once and kept for the load.

    One load into a table at a time, as ids go on from the highest one there. The load is noted
    in the table's journal before its first row is written, and its highest id after the last one
    is published; a load that fails publishes nothing, and ids go on without a gap. Source and place
    themselves are not stored. Rows must keep them when they are read again, as rows read from
    files do. A column the table lacks is an error; a table column the frame lacks becomes NULL.
    With a ``partition`` (SQL text of its values), its rows are replaced.
    """
    target = spark.table(f"`{database}`.`{table}`").columns
    unknown = [c for c in df.columns if c not in target and c not in (source, place)]
    if unknown:
        raise ValueError(f"{table} has no column {', '.join(unknown)}")
    counts = df.groupBy(F.col(source).alias("source")).agg(F.max(place).alias("_rows"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = stage(counts.repartitionByRange(ranges, "source").withColumn("_range", F.spark_partition_id()), "counts")
    view = f"rows_{kept.rsplit('_', 1)[-1]}"
    try:
        start = high_id(spark, database, table) if start is None else start
        numbered = (F.col("_offset") + F.col(place) + F.lit(start)).cast("bigint").alias(ID)
        joined = df.join(row_offsets(spark.table(kept)), F.col(source) == F.col("source"))
        rows = joined.select(numbered, *[F.col(f"`{c}`") for c in df.columns if c != ID])
        named = [c for c in target if f"`{c}`" not in partition]
        columns = [F.col(f"`{c}`") if c in rows.columns else F.lit(None).alias(c) for c in named]
        counted = Observation()
        counting = rows.select(*columns).observe(counted, F.count(F.lit(1)).alias("rows"))
        note(spark, database, table, **{OPEN: kept})
        if partition:
            counting.createOrReplaceTempView(view)
            spark.sql(f"INSERT OVERWRITE `{database}`.`{table}` PARTITION ({partition}) SELECT * FROM {view}")
        else:
            counting.write.mode("append").insertInto(f"`{database}`.`{table}`")
        added = counted.get["rows"]
        high = max(start + added, int(journal(spark, database, table).get(HIGH, 0)))
        note(spark, database, table, **{HIGH: high, OPEN: ""})
        return added
    finally:
        spark.catalog.dropTempView(view)
        unstage(spark, kept)


def with_file_places(files: DataFrame) -> DataFrame:
    """Rows read from parquet files with their file and their place in it."""
    return files.select(
        F.col("_metadata.file_path").alias(FILE),
        (F.col("_metadata.row_index") + 1).alias(PLACE),
        *[f"`{c}`" for c in files.columns],
    )


def last_id(spark: SparkSession, database: str, table: str, where: str = "true") -> int:
    found = spark.table(f"`{database}`.`{table}`").where(where).agg(F.max(ID)).first()[0]
    return found or 0


def append_rows(
    spark: SparkSession, df: DataFrame, database: str, table: str, partition: str = "", start: int | None = None
) -> int:
    """Appends any frame; its rows are written down first, to have places that last."""
    staged = stage(df, "append")
    try:
        placed = with_file_places(spark.table(staged))
        return append_numbered(spark, placed, FILE, PLACE, database, table, partition, start)
    finally:
        unstage(spark, staged)


def load_frame(
    spark: SparkSession, df: DataFrame, layout: Sequence[LoadColumn], database: str, table: str
) -> int:
    """Creates the table where missing and appends the rows."""
    create_table(spark, database, table, layout)
    return append_rows(spark, df.select(*[f"`{c.name}`" for c in layout]), database, table)


def load_files(
    spark: SparkSession, files: DataFrame, layout: Sequence[LoadColumn], database: str, table: str
) -> int:
    """The same for a frame read from parquet files as it is: its rows have places there already."""
    create_table(spark, database, table, layout)
    rows = frame_to_load(with_file_places(files), layout, keep=(FILE, PLACE))
    return append_numbered(spark, rows, FILE, PLACE, database, table)


def drop_tables(spark: SparkSession, database: str, tables: Sequence[str]) -> list[tuple[str, bool, str]]:
    """Drops each table that is there; a failure is noted and the others go on.

    Returns ``(table, was there and is gone, error)`` for each name.
    """
    results = []
    for table in tables:
        try:
            there = spark.catalog.tableExists(f"`{database}`.`{table}`")
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
            results.append((table, there, ""))
        except PySparkException as error:
            results.append((table, False, str(error)))
    return results


def show_rows(df: DataFrame, n: int = 20) -> None:
    """Prints the first rows."""
    df.show(n, truncate=False)


__all__ = [
    "append_numbered",
    "append_rows",
    "batch_start",
    "create_database",
    "create_table",
    "drop_tables",
    "high_id",
    "journal",
    "last_id",
    "load_files",
    "load_frame",
    "row_offsets",
    "show_rows",
    "with_file_places",
]
