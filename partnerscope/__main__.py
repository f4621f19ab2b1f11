"""Jobs from the command line, for ``python -m partnerscope`` or ``spark-submit``."""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from partnerscope.functions.naming import HEADER_RULES, with_headings
from partnerscope.operators.report import REPORT_COLUMNS
from partnerscope.operators.tables import create_database, show_rows
from partnerscope.params import default_params
from partnerscope.plans import jobs

# Rows printed of a result; the result itself is a table.
SHOWN = 100


def _arguments(values: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="partnerscope", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    report = commands.add_parser("report", help="load both feeds, print the report and its digest, drop the tables")
    report.add_argument("partners", help="workbook, folder or glob of the partner feed")
    report.add_argument("orders", help="workbook, folder or glob of the order feed")
    report.add_argument("--database", default=jobs.DEFAULT_DATABASE)
    report.add_argument("--year", type=int, help="year reported, against the year before")
    load = commands.add_parser("load", help="load workbooks into a table")
    load.add_argument("path")
    load.add_argument("--database", default=jobs.DEFAULT_DATABASE)
    load.add_argument("--table", help="by default named after the file")
    load.add_argument("--rule", choices=sorted(HEADER_RULES), default="ascii", help="letters kept in column names")
    load.add_argument("--tidy", action="store_true", help="columns with a zero as text, zeros empty")
    load.add_argument("--wide", action="store_true", help="64-bit numbers")
    query = commands.add_parser("query", help="save the result of a query as a table, print its first rows, then drop the tables named")
    query.add_argument("text")
    query.add_argument("--database", default=jobs.DEFAULT_DATABASE)
    query.add_argument("--drop", nargs="*", default=[], metavar="TABLE")
    query.add_argument("--save-as", metavar="TABLE", help="by default a new table in the database")
    return parser.parse_args(values)


def main(values: Sequence[str] | None = None) -> None:
    given = _arguments(values)
    spark = SparkSession.builder.appName("partnerscope").getOrCreate()
    if given.command == "report":
        params = default_params()
        if given.year:
            params = default_params(current_year=given.year, prior_year=given.year - 1)

        def deliver(delivery: jobs.Delivery) -> None:
            show_rows(with_headings(delivery.report.select(*REPORT_COLUMNS), params), SHOWN)
            print(delivery.message)

        jobs.load_report_cleanup(
            spark, given.partners, given.orders, given.database, params, deliver, rule="unicode", tidy=True
        )
    elif given.command == "load":
        table, rows = jobs.load_sheet(
            spark, given.path, given.database, given.table, given.rule, given.tidy, given.wide
        )
        print(f"{rows} rows added to {table}")
    else:
        create_database(spark, given.database)
        saved = given.save_as or f"{given.database}.result_{uuid.uuid4().hex}"

        def tell(result: DataFrame) -> None:
            print(f"{result.count()} rows saved as {saved}; the first {SHOWN} at most:")
            show_rows(result, SHOWN)

        jobs.query_then_drop(spark, given.text, given.database, given.drop, tell, save_as=saved)


if __name__ == "__main__":
    main()
