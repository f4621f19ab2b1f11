"""Whole jobs: load feeds, report, deliver, clean up. Plain functions on the driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from partnerscope.functions.naming import catalog_name, table_name
from partnerscope.operators.cells import fail_if_empty
from partnerscope.operators.digest import digest_message
from partnerscope.operators.measures import order_view, partner_view, with_common_codes
from partnerscope.operators.report import in_report_order, partner_report
from partnerscope.operators.tables import append_numbered, create_table, drop_tables
from partnerscope.params import ORDER_TABLE, PARTNER_TABLE, ReportParams
from partnerscope.session import kept, stage, unstage
from partnerscope.sources.feeds import sheet_frame, sheet_layout
from partnerscope.sources.workbook import read_workbooks
from partnerscope.streaming.ingest import ingest_sheets

DEFAULT_DATABASE = "excel_import"
FEED_TABLES = (PARTNER_TABLE, ORDER_TABLE)


def run_query(spark: SparkSession, text: str | None = None, default: str | None = None, **values) -> DataFrame:
    """A query given as text, or the default one; values go in as named parameters."""
    query = text or default
    if not query:
        raise ValueError("no query given")
    return spark.sql(query, args=values or None)


def load_sheet(
    spark: SparkSession,
    path: str,
    database: str | None = None,
    table: str | None = None,
    rule: str = "ascii",
    tidy: bool = False,
    wide: bool = False,
) -> tuple[str, int]:
    """Loads workbooks into a table, by default named after the file; returns it and the rows added."""
    database, table = database or DEFAULT_DATABASE, table or catalog_name(table_name(path))
    return f"{database}.{table}", load_sheet_rows(read_workbooks(spark, path), database, table, rule, tidy, wide)


def load_sheet_rows(
    rows: DataFrame, database: str, table: str, rule: str = "ascii", tidy: bool = False, wide: bool = False
) -> int:
    """Loads sheet rows into a table and returns how many were added.

    The rows are staged: opening workbooks is the costly step, and both the choice of
    types and the load read them.
    """
    spark = rows.sparkSession
    staged = stage(rows, "sheets")
    try:
        kept = spark.table(staged)
        layout = sheet_layout(kept, rule, tidy, wide)
        create_table(spark, database, table, layout)
        return append_numbered(spark, sheet_frame(kept, layout), "path", "row_no", database, table)
    finally:
        unstage(spark, staged)


def upload_partners(spark: SparkSession, path: str, database: str, **options) -> int:
    return load_sheet(spark, path, database, PARTNER_TABLE, **options)[1]


def upload_orders(spark: SparkSession, path: str, database: str, **options) -> int:
    return load_sheet(spark, path, database, ORDER_TABLE, **options)[1]


def upload_new(spark: SparkSession, landing: str, database: str, table: str, checkpoint: str, layout) -> int:
    """Uploads the workbooks that landed since the last call, each once; returns the rows added."""
    return ingest_sheets(spark, landing, layout, database, table, checkpoint)


@dataclass(frozen=True)
class Delivery:
    """A report kept in the shared folder, and its digest."""

    report: DataFrame
    message: str


def generate_report(spark: SparkSession, database: str, params: ReportParams) -> Delivery:
    """The report over the two loaded tables, computed once, so it outlives them."""
    partners, orders = with_common_codes(
        partner_view(spark.table(f"`{database}`.`{PARTNER_TABLE}`")),
        order_view(spark.table(f"`{database}`.`{ORDER_TABLE}`")),
    )
    report = kept(partner_report(partners, orders, params))
    message = digest_message(report, params).first()["message"]
    return Delivery(in_report_order(report), message)


def cleanup(spark: SparkSession, database: str, tables: Sequence[str] = FEED_TABLES) -> list[tuple[str, bool, str]]:
    return drop_tables(spark, database, tables)


def load_report_cleanup(
    spark: SparkSession,
    partner_path: str,
    order_path: str,
    database: str,
    params: ReportParams,
    deliver: Callable[[Delivery], None] = lambda delivery: None,
    **options,
) -> Delivery:
    """Both feeds, the report, its delivery, then the tables go. They stay if a step fails."""
    upload_partners(spark, partner_path, database, **options)
    upload_orders(spark, order_path, database, **options)
    delivery = generate_report(spark, database, params)
    fail_if_empty(delivery.report)
    deliver(delivery)
    cleanup(spark, database)
    return delivery


def query_then_drop(
    spark: SparkSession,
    query: str,
    database: str,
    tables: Sequence[str] = FEED_TABLES,
    deliver: Callable[[DataFrame], None] = lambda result: None,
    save_as: str | None = None,
    **values,
) -> DataFrame:
    """Runs a query, keeps and delivers its result, and only then drops the tables.

    The whole result is a new table where ``save_as`` names one, or else held in the shared folder.
    """
    found = run_query(spark, query, **values)
    if save_as:
        found.write.format("parquet").saveAsTable(save_as)
        result = spark.table(save_as)
    else:
        result = kept(found)
    fail_if_empty(result)
    deliver(result)
    cleanup(spark, database, tables)
    return result


__all__ = [
    "Delivery",
    "cleanup",
    "generate_report",
    "load_report_cleanup",
    "load_sheet",
    "load_sheet_rows",
    "query_then_drop",
    "run_query",
    "upload_new",
    "upload_orders",
    "upload_partners",
]
