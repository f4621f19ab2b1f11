"""Digest, cells, profile and database options."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_report import CDC, GOLDEN, OK, ORDERS, P, PARTNERS, frames

from partnerscope import default_params
from partnerscope.operators import cells, digest, profile, report
from partnerscope.sources import jdbc


@pytest.fixture(scope="module")
def made(spark):
    return report.partner_report(*frames(spark, PARTNERS, ORDERS), P).checkpoint()


def test_digest_parts(made):
    assert tuple(digest.digest_parts(made).first()) == (
        2, "BLC (1), CGC (1), CĐC (0)", "66.7%", "BLC (100.0%), CĐC (100.0%), CGC (0.0%)", "CGC (0.0%), BLC (100.0%), CĐC (100.0%)",
    )
    assert digest.overall_rate(made) == "66.7%"
    with pytest.raises(ValueError, match="no total"):
        digest.overall_rate(made.where("not is_total"))


def test_ties_go_by_department(spark):
    names = [d.name for d in P.ordered_departments()]
    partners = [(f"C{i}", names[i], OK, "2025") for i in (5, 3, 9, 1)]
    tied = report.partner_report(*frames(spark, partners, []), P)
    assert [r.dept for r in digest.top_by_count(tied).collect()] == ["CĐC", "CTH", "ĐHE"]
    assert [r.dept for r in digest.bottom_by_rate(tied).collect()] == ["CĐC", "CTH", "ĐHE"]
    assert [r.dept for r in digest.top_by_rate(tied, 1).collect()] == ["CĐC"]


def test_text_total(spark):
    df = spark.createDataFrame([("3",), ("",), ("4",), ("x",)], "v string")
    assert digest.text_total(df, "v").first().total == 7
    assert digest.text_total(df.where("false"), "v").first().total == 0


def test_title():
    assert digest.report_title(default_params(as_of=dt.date(2025, 5, 19))).endswith("(01.01.2025 - 19.05.2025)")


def test_total_last_by_name(spark, made):
    moved = cells.total_last(made.drop("is_total").select("dept", "new_current").orderBy("new_current"))
    assert [r.dept for r in moved.where("is_total").collect()] == ["TỔNG CỘNG"]
    unlabelled = spark.createDataFrame([(None, 1), ("TỔNG CỘNG", 2)], "dept string, n int")
    assert [r.is_total for r in cells.total_last(unlabelled).orderBy("n").collect()] == [False, True]


def test_banded_cells(made):
    found = {(r.row, r.col): r for r in cells.banded_cells(made, P).collect()}
    assert len(found) == 4 * 13
    assert found[0, 0].background == "#ffffff" and found[1, 0].background == "#eaf6ea"
    assert found[0, 7].background == "#4CAF50" and found[2, 7].background == "#EF9A9A"
    assert {found[3, c].background for c in range(13)} == {"#0074bc"} and found[3, 0].weight == "bold"
    assert found[0, 7].heading == "TL CTVLK\nPTM25" and found[3, 9].text == "66.7%"


def test_numbered_cells(made):
    numbered = report.numbered_report(made)
    found = {(r.row, r.col): r for r in cells.numbered_cells(numbered, P).collect()}
    assert len(found) == 4 * 12
    assert [found[i, 0].text for i in range(4)] == ["1", "2", "3", ""]
    assert found[3, 1].text == "TỔNG\nCỘNG" and found[3, 1].background == "#0072BC"
    assert found[3, 10].heading == "TL CTVLK PS" and found[3, 10].background == "#90EE90"
    assert found[0, 3].text == "-" and found[0, 3].background == "white" and found[1, 3].background == "#E8F4E8"


def test_shapes(spark, made):
    df = spark.createDataFrame([(1, "a", "b")], "stt int, `x y` string, z string")
    assert cells.drop_first_column(df).columns == ["x y", "z"]
    assert cells.drop_if_present(df, "STT").columns == ["x y", "z"] and cells.drop_if_present(df, "no").columns == df.columns
    assert cells.fail_if_empty(df) is df
    with pytest.raises(ValueError, match="no rows"):
        cells.fail_if_empty(df.where("false"))


def test_profile(spark):
    df = spark.createDataFrame([(1, "abc", None, 1.0), (2, None, None, float("nan")), (3, "", None, 2.0)], "id long, a string, b int, c double")
    assert {tuple(r) for r in profile.null_profile(df).collect()} == {("a", 1), ("b", 3), ("c", 1)}
    assert {tuple(r) for r in profile.rows_per_column(df).collect()} == {("a", 3), ("b", 3), ("c", 3)}
    assert profile.rows_per_column(df.where("false")).count() == 0
    found = {r.column_name: r for r in profile.table_profile(df, "t").collect()}
    assert (found["a"].data_type, found["a"].total_rows, found["a"].null_count, found["a"].longest_text) == ("string", 3, 1, 3)
    assert [r.id for r in profile.head(df, F.desc("id"), n=2).collect()] == [3, 2]
    assert profile.row_count(df).first().total_rows == 3


def test_catalog(spark):
    spark.sql("CREATE OR REPLACE TEMP VIEW listed AS SELECT 1 AS a, 'x' AS b")
    assert [(r.column_name, r.data_type, r.max_length) for r in profile.table_columns(spark, "listed").collect()] == [("a", "int", None), ("b", "string", None)]
    assert [r.col_name for r in profile.describe_table(spark, "listed").collect()] == ["a", "b"]
    spark.sql("CREATE DATABASE IF NOT EXISTS catalog_test")
    spark.sql("CREATE TABLE IF NOT EXISTS catalog_test.sized (v VARCHAR(255), n INT) USING parquet")
    rows = profile.table_columns(spark, "sized", "catalog_test").where("column_name = 'v'").collect()
    assert [(r.table_schema, r.max_length) for r in rows] == [("catalog_test", 255)]


def test_database_options():
    database = jdbc.Database("jdbc:mysql://host/db", {"user": "u", "password": "p"})
    assert "password" not in repr(database)
    assert jdbc.query_options(database, "SELECT 1 ; ") == {
        "url": "jdbc:mysql://host/db", "user": "u", "password": "p", "driver": "com.mysql.cj.jdbc.Driver", "query": "SELECT 1",
        "fetchsize": "10000", "useCursorFetch": "true",
    }
    assert jdbc.query_options(jdbc.Database("jdbc:mysql://h/d", {"fetchsize": "7"}), "SELECT 1")["fetchsize"] == "7"
    sliced = jdbc.query_options(database, "SELECT * FROM t", jdbc.Slices("id", 1, 1000, 8))
    assert sliced["dbtable"] == "(SELECT * FROM t) sliced" and sliced["numPartitions"] == "8" and "query" not in sliced
    assert jdbc.Database("jdbc:oracle:thin:@h:1521/x").options()["driver"].startswith("oracle.")
    assert jdbc.Database("jdbc:sqlserver://h").options()["driver"].endswith("SQLServerDriver")


def test_database_reports(spark):
    branches = spark.createDataFrame([(1, "BLC", CDC, "M1", 9)], "DONVI_ID long, TEN_NGAN string, TEN string, MA_DV string, x int")
    assert jdbc.branch_list(branches).columns == ["DONVI_ID", "TEN_NGAN", "TEN", "MA_DV"]
    schema = "PBH string, thucuoc int, cskh_ob int, cskh_ob_nc int, cskh_sla_lonhon_72 int, baohong int, tuvan int, td_tocdo int, tong_ton int"
    table = spark.createDataFrame([("BLC", 1, 2, 3, 4, 5, 6, 7, 8)], schema)
    assert jdbc.backlog(table).columns[3:5] == ["ob_nc", "sla > 72"] and len(jdbc.backlog(table).columns) == 9
    assert len(jdbc.backlog(table, short=True).columns) == 8


def test_sample_is_the_golden_report(made):
    assert [tuple(r) for r in report.in_report_order(made).select(*report.REPORT_COLUMNS).collect()] == GOLDEN
