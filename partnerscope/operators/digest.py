"""The ranked digest of a report: totals, best and worst three, one message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerscope.functions.rates import percent_number
from partnerscope.functions.values import blank_as_zero
from partnerscope.params import ReportParams

TOP = 3


def _departments(report: DataFrame) -> DataFrame:
    return report.where(~F.col("is_total"))


def _overall_rate() -> Column:
    return percent_number(F.col("rate_overall"))


def top_by_count(report: DataFrame, n: int = TOP) -> DataFrame:
    """Departments with most new partners; ties go by department order."""
    return _departments(report).orderBy(F.desc("new_current"), "ord").limit(n).select("dept", "new_current")


def top_by_rate(report: DataFrame, n: int = TOP) -> DataFrame:
    """Departments with the best overall rate; ties go by department order."""
    return _departments(report).orderBy(_overall_rate().desc(), "ord").limit(n).select("dept", "rate_overall")


def bottom_by_rate(report: DataFrame, n: int = TOP) -> DataFrame:
    """Departments with the worst overall rate; ties go by department order."""
    return _departments(report).orderBy(_overall_rate().asc(), "ord").limit(n).select("dept", "rate_overall")


def digest_parts(report: DataFrame, n: int = TOP) -> DataFrame:
    """One row with the parts of the digest, from one reading of the report.

    The report has one row per department, so ranking it is small work.
    """
    group = Window.partitionBy("is_total")
    ranked = report.select(
        "dept",
        "is_total",
        "rate_overall",
        F.expr("try_cast(new_current AS bigint)").alias("new_current"),
        F.row_number().over(group.orderBy(F.desc("new_current"), "ord")).alias("by_count"),
        F.row_number().over(group.orderBy(_overall_rate().desc(), "ord")).alias("by_best"),
        F.row_number().over(group.orderBy(_overall_rate().asc(), "ord")).alias("by_worst"),
    )

    def listed(shown: str, rank: str) -> Column:
        return F.expr(
            f"listagg(CASE WHEN NOT is_total AND {rank} <= {int(n)} "
            f"THEN concat(dept, ' (', CAST({shown} AS STRING), ')') END, ', ') "
            f"WITHIN GROUP (ORDER BY {rank})"
        )

    return ranked.agg(
        F.coalesce(F.sum(F.when(~F.col("is_total"), F.col("new_current"))), F.lit(0)).alias("total_new"),
        listed("new_current", "by_count").alias("top_count"),
        F.max(F.when(F.col("is_total"), F.col("rate_overall"))).alias("overall_rate"),
        listed("rate_overall", "by_best").alias("top_rate"),
        listed("rate_overall", "by_worst").alias("bottom_rate"),
    )


def digest_message(report: DataFrame, params: ReportParams) -> DataFrame:
    """The digest as one text. The date is a parameter, so results repeat."""
    day = params.report_date().strftime("%d/%m/%Y")
    # The lines of the message.
    lines = (
        f"ĐIỂM TIN  KẾT QUẢ TRIỂN KHAI MÔ HÌNH CTV LIÊN KẾT NĂM {params.current_year} (tính đến ngày {day})\n",
        "- Số lượng CTV Liên kết phát triển mới: Tổng %s CTV Liên kết. Trong đó:\n",
        "+ PBH đạt số lượng CTV cao nhất là: %s.\n",
        f"- Tỷ lệ CTV LK PSSL năm {params.current_year}: Tỷ lệ chung đạt %s. Trong đó:\n",
        "+ PBH đạt tỷ lệ cao nhất: %s.\n",
        "+ PBH đạt tỷ lệ thấp nhất: %s.\n",
    )
    parts = digest_parts(report)
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in parts.columns]
    return parts.select(F.format_string("".join(lines), *shown).alias("message"))


def text_total(df: DataFrame, column: str) -> DataFrame:
    """Sum of whole numbers held as text, an empty text counting as 0."""
    number = blank_as_zero(F.col(column)).try_cast("bigint")
    return df.agg(F.coalesce(F.sum(number), F.lit(0)).alias("total"))


def report_title(params: ReportParams) -> str:
    """Heading of the table picture with the reported period."""
    day = params.report_date().strftime("%d.%m.%Y")
    year = params.current_year
    # The heading.
    return f"Báo cáo kết quả triển khai Mô hình CTV LK Năm {year}\n(01.01.{year} - {day})"


def overall_rate(report: DataFrame) -> str:
    """The total row's rate; an error where the report has no total row."""
    row = report.where("is_total").select("rate_overall").first()
    if row is None:
        raise ValueError("the report has no total row")
    return row["rate_overall"]
