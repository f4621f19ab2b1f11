"""The report's two inputs, their predicates, and the counts taken from them.

Partners have ``code, dept, status, reg_text`` and orders ``code, ord_id,
date_text, status`` (and ``order_date`` for typed dates). ``pos`` is the place of
a department in the report order, from 0; the grand total has the place after
the last department.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partnerscope.functions.literals import text_list, text_literal
from partnerscope.params import ReportParams

# Columns that rows are grouped and joined by.
KEYS = ("code", "ord_id")

COUNTS = (
    "new_current",
    "new_prior",
    "new_either",
    "active_current",
    "active_prior",
    "orders_raised",
    "orders_ok",
)


def partner_view(table: DataFrame) -> DataFrame:
    """Partners from the positional columns of the partner feed."""
    return table.select(
        F.col("col_3").alias("code"),
        F.col("col_14").alias("dept"),
        F.col("col_22").alias("status"),
        F.col("col_17").cast("string").alias("reg_text"),
    )


def order_view(table: DataFrame) -> DataFrame:
    """Orders from the positional columns of the order feed."""
    return table.select(
        F.col("col_12").alias("code"),
        F.col("col_3").alias("ord_id"),
        F.col("col_25").cast("string").alias("date_text"),
        F.col("col_27").alias("status"),
    )


def with_common_codes(partners: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Codes of one type on both sides.

    A code column loads as numbers, but as text such as ``7.0`` where it has blanks. If
    the sides differ, both become text without that ending.
    """
    if partners.schema["code"].dataType == orders.schema["code"].dataType:
        return partners, orders
    plain = F.expr("regexp_replace(CAST(code AS string), '[.]0$', '')")
    return partners.withColumn("code", plain), orders.withColumn("code", plain)


def apply_text_rules(df: DataFrame, params: ReportParams) -> DataFrame:
    """Blank and collation rules on every text column; no-op by default.

    Keys get no collation, as a grouping by collated text sorts; see ``with_one_spelling``.
    """
    if params.collation is None and not params.blank_as_null:
        return df
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            if params.blank_as_null:
                column = F.when(column != "", column)
            if params.collation is not None and field.name not in KEYS:
                column = F.collate(column, params.collation)
        out.append(column.alias(field.name))
    return df.select(*out)


def with_one_spelling(frames: Sequence[DataFrame], key: str, collation: str) -> list[DataFrame]:
    """The frames with one spelling, the first in order, for keys that meet under the collation.

    Distinct spellings are found by hashing; only they are grouped by collation. The rows
    themselves meet their spelling by an ordinary join.
    """
    texts = [f.select(key) for f in frames if key in f.columns and isinstance(f.schema[key].dataType, T.StringType)]
    if not texts:
        return list(frames)
    every = texts[0]
    for more in texts[1:]:
        every = every.unionAll(more)
    spellings = every.where(F.col(key).isNotNull()).distinct()
    first = spellings.groupBy(F.collate(key, collation).alias("_text")).agg(F.min(key).alias("_first"))
    pairs = spellings.join(first, F.collate(key, collation) == F.col("_text")).select(F.col(key).alias("_spelling"), "_first")

    def respelled(frame: DataFrame) -> DataFrame:
        if key not in frame.columns or not isinstance(frame.schema[key].dataType, T.StringType):
            return frame
        joined = frame.join(pairs, F.col(key) == F.col("_spelling"), "left")
        return joined.select(*[F.col("_first").alias(key) if c == key else F.col(c) for c in frame.columns])

    return [respelled(f) for f in frames]


def with_text_keys(partners: DataFrame, orders: DataFrame | None, params: ReportParams) -> list[DataFrame]:
    """Both inputs with their keys as the report's collation wants them."""
    frames = [partners] if orders is None else [partners, orders]
    if params.collation is not None:
        frames = with_one_spelling(frames, "code", params.collation)
        frames[1:] = with_one_spelling(frames[1:], "ord_id", params.collation)
    return frames


def collated_counts(df: DataFrame, column: str, collation: str) -> DataFrame:
    """Rows per text under a collation, with the first of the spellings that meet there.

    Spellings are counted as they stand first, by hashing; grouping by collation sorts,
    and has only the distinct spellings left to sort.
    """
    spelled = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return (
        spelled.groupBy(F.collate(column, collation).alias("_text"))
        .agg(F.min(column).alias(column), F.sum("n").alias("n"))
        .drop("_text")
    )


def year_in_text(text: str, year: int) -> Column:
    """The year stands anywhere in the text."""
    return F.expr(f"contains({text}, '{year:d}')")


def year_of_date(date: str, year: int) -> Column:
    """The date lies in the year, as a range that a scan can use."""
    start, end = (f"TIMESTAMP_NTZ'{y:04d}-01-01 00:00:00'" for y in (year, year + 1))
    return F.expr(f"{date} >= {start} AND {date} < {end}")


def _decoded(dept: str, params: ReportParams, values: list[str], kind: str) -> Column:
    branches = " ".join(
        f"WHEN {text_literal(d.name)} THEN {value}"
        for d, value in zip(params.ordered_departments(), values)
    )
    return F.expr(f"CAST(CASE {dept} {branches} END AS {kind})")


def department_position(dept: str, params: ReportParams) -> Column:
    """Place of the department in the report, from 0; NULL for any other text."""
    return _decoded(dept, params, [str(i) for i in range(len(params.departments))], "int")


def department_code(dept: str, params: ReportParams) -> Column:
    """Short code of the department; NULL for any other text."""
    return _decoded(dept, params, [text_literal(d.code) for d in params.ordered_departments()], "string")


def department_ordinal(dept: str, params: ReportParams) -> Column:
    """Ordinal of the department; NULL for any other text."""
    return _decoded(dept, params, [str(d.ordinal) for d in params.ordered_departments()], "int")


def in_departments(dept: str, params: ReportParams) -> Column:
    return F.expr(f"{dept} IN ({text_list(d.name for d in params.departments)})")


def listed_partners(partners: DataFrame, params: ReportParams, keep: Sequence[str] = ()) -> DataFrame:
    """Partners of the reported departments with their flags.

    ``pos, code, verified, is_current, is_prior`` and the columns to keep; the flags of a
    partner without code are false, as such a partner is never counted nor joined.
    """
    verified = f"coalesce(status = {text_literal(params.verified)} AND code IS NOT NULL, false)"
    registered = f"{verified} AND coalesce(contains(reg_text, '%d'), false) AS %s"
    return (
        apply_text_rules(partners, params)
        .where(in_departments("dept", params))
        .select(
            department_position("dept", params).alias("pos"),
            "code",
            F.expr(f"{verified} AS verified"),
            F.expr(registered % (params.current_year, "is_current")),
            F.expr(registered % (params.prior_year, "is_prior")),
            *keep,
        )
    )


def year_orders(orders: DataFrame, params: ReportParams, keep: Sequence[str] = ()) -> DataFrame:
    """Orders of the current year that have a partner code: ``code, ord_id, ok``, and the columns to keep."""
    if params.typed_dates:
        in_year = year_of_date("order_date", params.current_year)
    else:
        in_year = year_in_text("date_text", params.current_year)
    return (
        apply_text_rules(orders, params)
        .where(in_year)
        .where("code IS NOT NULL")
        .selectExpr("code", "ord_id", f"coalesce(status = {text_literal(params.success)}, false) AS ok", *keep)
    )


def order_facts(orders: DataFrame, params: ReportParams) -> DataFrame:
    """Each order of the year once for each partner code: ``code, ord_id, ok``.

    Everything the report takes from the orders comes from this grouping, written the same
    way each time, so one scan and one shuffle of the orders serve all of it.
    """
    return year_orders(orders, params).groupBy("code", "ord_id").agg(F.expr("bool_or(ok) AS ok"))


def success_codes(orders: DataFrame, params: ReportParams) -> DataFrame:
    """Codes with a successful order in the current year, each once."""
    return order_facts(orders, params).groupBy("code").agg(F.expr("bool_or(ok) AS good")).where("good").select("code")
