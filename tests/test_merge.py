"""Feeds with differing headers as one frame."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from partnerscope.sources import feeds

INT, LONG, DOUBLE, TEXT, DATE = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType()
STAMP, PLAIN = T.TimestampType(), T.TimestampNTZType()


@pytest.mark.parametrize(
    "first, second, common",
    [
        (INT, INT, INT),
        (INT, LONG, LONG),
        (LONG, DOUBLE, DOUBLE),
        (T.FloatType(), INT, DOUBLE),
        (DOUBLE, TEXT, TEXT),
        (T.BooleanType(), INT, TEXT),
        (T.NullType(), DATE, DATE),
        (DATE, STAMP, STAMP),
        (DATE, PLAIN, PLAIN),
        (STAMP, PLAIN, TEXT),
        (DATE, INT, TEXT),
        (T.DecimalType(10, 2), INT, T.DecimalType(12, 2)),
        (T.DecimalType(10, 2), T.DecimalType(8, 4), T.DecimalType(12, 4)),
        (T.DecimalType(38, 10), T.DecimalType(38, 0), DOUBLE),
    ],
)
def test_common_type(first, second, common):
    assert feeds.common_type(first, second) == common
    assert feeds.common_type(second, first) == common


def test_the_common_type_depends_on_no_order():
    kinds = [INT, LONG, DOUBLE, TEXT, T.ShortType(), T.DecimalType(20, 3)]
    for a in kinds:
        for b in kinds:
            for c in kinds:
                left = feeds.common_type(feeds.common_type(a, b), c)
                assert left == feeds.common_type(a, feeds.common_type(b, c))


def test_nested_types_that_differ(spark):
    with pytest.raises(ValueError, match="no type in common"):
        feeds.common_type(T.ArrayType(INT), INT)


def test_merged_rows(spark):
    whole = spark.createDataFrame([(1, 2, True), (None, 3, None)], "k int, n long, flag boolean")
    fractional = spark.createDataFrame([(2.5, "x", 7)], "N double, `a b` string, K long")
    named = spark.createDataFrame([("T", dt.date(2025, 1, 2))], "k string, day date")
    merged = feeds.merged_frames([whole, fractional, named])
    assert merged.dtypes == [("k", "string"), ("n", "double"), ("flag", "boolean"), ("a b", "string"), ("day", "date")]
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(
        [
            ("1", 2.0, True, None, None),
            (None, 3.0, None, None, None),
            ("7", 2.5, None, "x", None),
            ("T", None, None, None, dt.date(2025, 1, 2)),
        ],
        key=str,
    )


def test_numbers_that_meet_text_are_written_as_loaded(spark):
    numbers = spark.createDataFrame([(2.0, True), (1e20, False)], "v double, b boolean")
    texts = spark.createDataFrame([("x", "y")], "v string, b string")
    found = feeds.merged_frames([numbers, texts]).collect()
    assert sorted(map(tuple, found)) == [("100000000000000000000.0", "0"), ("2.0", "1"), ("x", "y")]


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "k int, only string")
    rows = spark.createDataFrame([(1,), (1,)], "k long")
    merged = feeds.merged_frames([empty, rows, rows])
    assert merged.dtypes == [("k", "bigint"), ("only", "string")] and merged.count() == 4
    with pytest.raises(ValueError, match="no frames"):
        feeds.merged_frames([])
    with pytest.raises(ValueError, match="several columns k"):
        feeds.merged_frames([rows.select("k", rows["k"].alias("K"))])


def test_a_scan_reads_its_own_columns_only(spark, folder):
    merged = feeds.read_merged(spark, [f"{folder}/customer.parquet", f"{folder}/supplier.parquet"])
    plan = merged.select("c_name")._jdf.queryExecution().executedPlan().toString()
    assert "c_acctbal" not in plan and "s_acctbal" not in plan and "Exchange" not in plan


def test_text_exports_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Mã số,Tên\n1,An\n2,\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("Tên,Ngày\nBình,1/2/2025\n", encoding="utf-8")
    merged = feeds.read_merged_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert merged.columns == ["m_s", "tn", "ngy"]  # this rule keeps ASCII only
    assert sorted(map(tuple, merged.collect())) == [("", "Bình", "1/2/2025"), ("1", "An", ""), ("2", "", "")]
