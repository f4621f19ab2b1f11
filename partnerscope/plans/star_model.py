"""Partners and orders taken from a star schema of customers, nations and orders.

Customers are the partners and nations their departments. A partner's status and
registration text follow from the market segment and the key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from partnerscope.params import Department, ReportParams

CURRENT_YEAR = 1998
PRIOR_YEAR = 1997


def star_params(**changes) -> ReportParams:
    values = dict(
        departments=tuple(Department(f"NATION_{i}", f"N{i:02d}", i) for i in range(1, 14)),
        current_year=CURRENT_YEAR,
        prior_year=PRIOR_YEAR,
        verified="verified",
        success="F",
        as_of=dt.date(CURRENT_YEAR, 12, 31),
    )
    values.update(changes)
    return ReportParams(**values)


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; its schema is looked up in the files once."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def star_partners(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    return customer.join(nation, F.expr("c_nationkey = n_nationkey")).selectExpr(
        "c_custkey AS code",
        "n_name AS dept",
        "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'pending' ELSE 'verified' END AS status",
        f"concat('15/03/', {PRIOR_YEAR} + c_custkey % 3) AS reg_text",
    )


def star_partners_extended(spark: SparkSession, folder: str) -> DataFrame:
    """The partners, a second department for every third, and one without code."""
    second = (
        table(spark, folder, "customer")
        .where("c_custkey % 3 = 0")
        .selectExpr(
            "c_custkey",
            "concat('NATION_', 1 + c_custkey % 13)",
            "CASE WHEN c_custkey % 2 = 0 THEN 'verified' ELSE 'pending' END",
            f"concat('01/01/', {PRIOR_YEAR} + c_custkey % 2)",
        )
    )
    without_code = spark.range(1).selectExpr("CAST(NULL AS bigint)", "'NATION_1'", "'verified'", f"'{CURRENT_YEAR}'")
    return star_partners(spark, folder).union(second).union(without_code)


def with_blank_codes(df: DataFrame) -> DataFrame:
    """Codes as text, every tenth of them empty: one code with a tenth of all rows."""
    return df.withColumn("code", F.expr("CASE WHEN code % 10 = 0 THEN '' ELSE CAST(code AS string) END"))


def with_mixed_codes(df: DataFrame) -> DataFrame:
    """Codes as texts with a letter that is a capital in every other row."""
    other = "crc32(CAST(coalesce(%s) AS binary)) %% 2 = 0" % ("CAST(ord_id AS string)" if "ord_id" in df.columns else "dept")
    return df.withColumn("code", F.expr(f"concat(CASE WHEN {other} THEN 'k' ELSE 'K' END, CAST(code AS string))"))


def with_mixed_case(df: DataFrame) -> DataFrame:
    """Status texts in capitals where the code is odd and in small letters elsewhere."""
    return df.withColumn("status", F.expr("CASE WHEN code % 2 = 1 THEN upper(status) ELSE lower(status) END"))


def star_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_custkey AS code",
        "o_orderkey AS ord_id",
        "date_format(o_orderdate, 'dd/MM/yyyy') AS date_text",
        "o_orderdate AS order_date",
        "o_orderstatus AS status",
    )
