"""Column listing and profiling of any table, one reading of the data each."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partnerscope.functions.values import is_fractional, is_missing


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """``col_name, data_type, comment`` of a table or view."""
    return spark.sql(f"DESCRIBE TABLE {table}")


def table_columns(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    """Columns of a table with type and declared text length, as a catalog would list them."""
    described = describe_table(spark, f"`{database}`.`{table}`" if database else table)
    rows = []
    for position, column in enumerate(described.collect(), start=1):
        if not column.col_name or column.col_name.startswith("#"):
            break  # partition details follow the columns
        sized = re.fullmatch(r"(?:var)?char\((\d+)\)", column.data_type)
        rows.append((database or "", table, position, column.col_name, column.data_type, int(sized[1]) if sized else None))
    schema = "table_schema string, table_name string, position int, column_name string, data_type string, max_length int"
    return spark.createDataFrame(rows, schema)


def head(df: DataFrame, *order: str, n: int = 10) -> DataFrame:
    """The first rows; by an order where one is given, so the result repeats."""
    return (df.orderBy(*order) if order else df).limit(n)


def row_count(df: DataFrame, alias: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def _per_column(row: DataFrame, names: list[str], fields: dict[str, str]) -> DataFrame:
    """One wide row of figures to a row per column; ``fields``: output name to figure prefix."""
    cells = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("column_name"),
            *[F.col(f"{prefix}{i}").alias(out) for out, prefix in fields.items()],
        )
        for i, name in enumerate(names)
    ]
    return row.select("total_rows", F.explode(F.array(*cells)).alias("c")).select("total_rows", "c.*")


def _profile_row(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    figures = [F.count(F.lit(1)).alias("total_rows")]
    for i, field in enumerate(fields):
        column = F.col(f"`{field.name}`")
        figures.append(F.count_if(is_missing(column, field.dataType)).alias(f"missing_{i}"))
        length = F.length(column) if isinstance(field.dataType, T.StringType) else F.lit(None).cast("int")
        figures.append(F.max(length).alias(f"longest_{i}"))
    return df.agg(*figures)


def null_profile(df: DataFrame, skip: tuple[str, ...] = ("id",)) -> DataFrame:
    """Missing values per column, columns without any left out."""
    fields = [f for f in df.schema.fields if f.name not in skip]
    wide = _profile_row(df, fields)
    narrow = _per_column(wide, [f.name for f in fields], {"null_count": "missing_"})
    return narrow.where(F.col("null_count") > 0).select("column_name", "null_count")


def rows_per_column(df: DataFrame, skip: tuple[str, ...] = ("id",)) -> DataFrame:
    """Every column with the number of rows of the table.

    This is the table crossed with its column list, counted per column and kept where
    the count is over 0. Each column meets every row once, so one count serves all.
    """
    names = [c for c in df.columns if c not in skip]
    listed = row_count(df).select("total_rows", F.explode(F.array(*[F.lit(c) for c in names])).alias("column_name"))
    return listed.where(F.col("total_rows") > 0).select("column_name", F.col("total_rows").alias("row_count"))


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """Type, missing values and longest text of every column, with the row count."""
    fields = df.schema.fields
    narrow = _per_column(
        _profile_row(df, fields), [f.name for f in fields], {"null_count": "missing_", "longest_text": "longest_"}
    )
    types = F.create_map(*[F.lit(x) for f in fields for x in (f.name, f.dataType.simpleString())])
    return narrow.select(
        F.lit(table).alias("table_name"),
        "position",
        "column_name",
        types[F.col("column_name")].alias("data_type"),
        "total_rows",
        "null_count",
        "longest_text",
    )


# Types whose bounds a footer has as numbers or dates.
BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)
NESTED = (T.ArrayType, T.MapType, T.StructType)
# The newer parquet reader, which can answer an aggregate from the statistics in the footers.
FROM_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
FOOTER_SCHEMA = (
    "table_name string, position int, column_name string, data_type string, total_rows bigint, null_count bigint, "
    "lowest double, highest double, first_date date, last_date date"
)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own over the same cluster, in which aggregates are answered from footers."""
    own = spark.newSession()
    for key, value in FROM_FOOTERS.items():
        own.conf.set(key, value)
    return own


def metadata_row(files: DataFrame) -> DataFrame:
    """Rows, values of each column, and bounds of number and date columns, as one row.

    All are figures that a footer has, so that of files read in a ``footer_session`` no column
    is scanned. NaN is no bound: a footer has none for it, and neither has a scan.
    """
    pushed = files.sparkSession.conf.get("spark.sql.parquet.aggregatePushdown") == "true"
    figures = [F.count(F.lit(1)).alias("total_rows")]
    for i, field in enumerate(files.schema.fields):
        column = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, NESTED):
            figures.append(F.count(column).alias(f"values_{i}"))
        if isinstance(field.dataType, BOUNDED):
            scanned = is_fractional(field.dataType) and not pushed
            bound = F.when(~F.isnan(column), column) if scanned else column
            figures += [F.min(bound).alias(f"lowest_{i}"), F.max(bound).alias(f"highest_{i}")]
    return files.agg(*figures)


def metadata_profile(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Types, rows, missing values and bounds of every column of parquet files, from their footers.

    Numbers have ``lowest`` and ``highest``, dates ``first_date`` and ``last_date``. Texts,
    timestamps and booleans have no bounds here, nested columns no count of missing values either:
    footers cut long texts and don't count what is nested. Missing is NULL; NaN counts as a
    value and is no bound. Files whose footers lack a figure are read instead. The driver sees
    one row.
    """
    files = footer_session(spark).read.parquet(path)
    try:
        found = metadata_row(files).first().asDict()
    except (PySparkException, Py4JJavaError) as error:
        if "aggregatePushdown" not in str(error):
            raise
        found = metadata_row(spark.read.parquet(path)).first().asDict()
    total = found["total_rows"] or 0  # footers without row groups have no figure at all
    rows = []
    for i, field in enumerate(files.schema.fields):
        values = None if isinstance(field.dataType, NESTED) else found[f"values_{i}"] or 0
        bounds = (found.get(f"lowest_{i}"), found.get(f"highest_{i}"))
        dates = isinstance(field.dataType, T.DateType)
        numbers = (None, None) if dates else tuple(None if b is None else float(b) for b in bounds)
        missing = None if values is None else total - values
        days = bounds if dates else (None, None)
        rows.append((table, i + 1, field.name, field.dataType.simpleString(), total, missing, *numbers, *days))
    return spark.createDataFrame(rows, FOOTER_SCHEMA)
