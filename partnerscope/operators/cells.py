"""A report as styled cells: text, background and weight of each.

Both styles work on the finished report of a few rows; the row place is a window
over those rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerscope.functions.naming import one_line_heading, report_headings, wrapped_headings
from partnerscope.functions.rates import band_colour, percent_band, rate_above
from partnerscope.functions.values import drop_point_zero, zero_dash
from partnerscope.operators.report import NUMBERED_COLUMNS, REPORT_COLUMNS
from partnerscope.params import ReportParams

# Colours of the banded style and of the numbered style.
BANDED = {"total": "#0074bc", "even": "#ffffff", "odd": "#eaf6ea"}
NUMBERED = {"total": "#0072BC", "even": "white", "odd": "#E8F4E8", "over": "#90EE90"}


def fail_if_empty(df: DataFrame) -> DataFrame:
    """The same rows; an error where there are none."""
    if df.isEmpty():
        raise ValueError("there are no rows to report")
    return df


def drop_first_column(df: DataFrame) -> DataFrame:
    return df.select(*[f"`{c}`" for c in df.columns[1:]])


def drop_if_present(df: DataFrame, column: str = "stt") -> DataFrame:
    return df.drop(column)


def total_last(df: DataFrame, label: str = "dept", total: str = "TỔNG CỘNG") -> DataFrame:
    """Main rows, then the total row: told apart by label, put together by name.

    A row without label belongs to the main rows. The frame is read twice: give one that
    is written down, not one that is costly to compute.
    """
    is_total = F.col(label).eqNullSafe(F.lit(total))
    main = df.where(~is_total).withColumn("is_total", F.lit(False))
    return main.unionByName(df.where(is_total).withColumn("is_total", F.lit(True)))


def display_report(numbered: DataFrame, params: ReportParams) -> DataFrame:
    """The numbered report as shown: plain number text, dash for 0, label on two lines."""
    two_lines = params.total_label.replace(" ", "\n")
    out = []
    for name in numbered.columns:
        column = F.col(name)
        if name == "stt":
            column = drop_point_zero(column.cast("string"))
        elif name == "dept":
            column = F.when(column == params.total_label, F.lit(two_lines)).otherwise(column)
        elif name not in ("is_total", "ord") and not name.startswith("rate_"):
            column = zero_dash(F.coalesce(column, F.lit(0)))
        out.append(column.alias(name))
    return numbered.select(*out)


def _placed(report: DataFrame) -> DataFrame:
    """Row place from 0: departments in order, the total after them."""
    whole = Window.partitionBy(F.lit(0)).orderBy("is_total", "ord")
    return report.withColumn("row", (F.row_number().over(whole) - 1).cast("int"))


def _unpivot(report: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row per cell: ``row, is_total, col, name, text``."""
    cells = [
        F.struct(F.lit(i).alias("col"), F.lit(c).alias("name"), F.col(c).cast("string").alias("text"))
        for i, c in enumerate(columns)
    ]
    return _placed(report).select("row", "is_total", F.explode(F.array(*cells)).alias("cell")).select(
        "row", "is_total", "cell.*"
    )


def _heading(names: dict[str, str]) -> Column:
    heading = F.col("name")
    for name, shown in names.items():
        heading = F.when(F.col("name") == name, F.lit(shown)).otherwise(heading)
    return heading


def _striped(style: dict[str, str]) -> Column:
    return F.when(F.col("row") % 2 == 0, F.lit(style["even"])).otherwise(F.lit(style["odd"]))


def banded_cells(report: DataFrame, params: ReportParams) -> DataFrame:
    """Cells of the 13-column report; a percent cell takes its band's colour."""
    short = wrapped_headings(params)
    names = {c: short.get(h, h) for c, h in report_headings(params).items()}
    cells = _unpivot(report, REPORT_COLUMNS)
    colour = F.coalesce(band_colour(percent_band(F.col("text"))), _striped(BANDED))
    return cells.select(
        "row",
        "col",
        _heading(names).alias("heading"),
        "text",
        F.when(F.col("is_total"), F.lit(BANDED["total"])).otherwise(colour).alias("background"),
        F.when(F.col("is_total"), F.lit("bold")).otherwise(F.lit("normal")).alias("weight"),
    )


def numbered_cells(numbered: DataFrame, params: ReportParams) -> DataFrame:
    """Cells of the numbered report as shown; a rate over 50 is marked in any row."""
    names = {c: one_line_heading(h, params) for c, h in report_headings(params).items()}
    cells = _unpivot(display_report(numbered, params), NUMBERED_COLUMNS)
    base = F.when(F.col("is_total"), F.lit(NUMBERED["total"])).otherwise(_striped(NUMBERED))
    marked = F.col("name").startswith("rate_") & rate_above(F.col("text"))
    return cells.select(
        "row",
        "col",
        _heading(names).alias("heading"),
        "text",
        F.when(marked, F.lit(NUMBERED["over"])).otherwise(base).alias("background"),
        F.when(F.col("is_total"), F.lit("bold")).otherwise(F.lit("normal")).alias("weight"),
    )
