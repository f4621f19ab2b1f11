import random

import pytest
from pyspark.sql import functions as F

from partnerscope.functions import naming
from partnerscope.plans.star_model import star_params

HEADERS = [" Họ Tên ", None, "", "Unnamed: 7", "2025 Số", "%%%", "Tên", "Tên", "a_b c", "ĐƠN\nHÀNG"]


def test_blank_headers():
    assert naming.fill_blank_headers(["a", None, "", "Unnamed: 3", "a"]) == ["a", "col_2", "col_3", "col_4", "a.1"]


def test_rules():
    assert naming.ascii_name(" Họ Tên 1!") == "h_tn_1"
    assert naming.unicode_name(" Họ Tên 1!") == "họ_tên_1"
    assert naming.table_column("2025 Số", 4) == "col_2025_số"
    assert naming.table_column("%%%", 6) == "col_6"


def test_column_names():
    assert naming.column_names(HEADERS, "unicode") == [
        "họ_tên", "col_2", "col_3", "col_4", "col_2025_số", "col_6", "tên", "tên1", "a_b_c", "đơnhàng",
    ]
    assert naming.column_names(["A B", "a_b", "a%b", "A_B"]) == ["a_b", "a_b_2", "ab", "a_b_3"]


@pytest.mark.parametrize("path, name", [("/x/Danh sách 1.xlsx", "danhsách1"), ("C:\\t\\A_b.v2.xls", "a_bv2"), ("plain", "plain")])
def test_table_name(path, name):
    assert naming.table_name(path) == name


def test_catalog_name():
    assert naming.catalog_name("đơnhàng_1") == "donhang_1"
    assert naming.catalog_name("表") == "sheet"


def test_columns_follow_the_same_rules(spark):
    names = [h for h in HEADERS if h] + ["\u00a0Tab\tx ", "١٢ x", "½", "e\u0301"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").orderBy("i")
    found = df.select(
        naming.ascii_name_column(F.col("n")), naming.unicode_name_column(F.col("n")), naming.table_column_column(F.col("n"), F.lit(9))
    ).collect()
    assert [tuple(r) for r in found] == [(naming.ascii_name(n), naming.unicode_name(n), naming.table_column(n, 9)) for n in names]


def test_headings():
    params = star_params(current_year=2025, prior_year=2024)
    full = naming.report_headings(params)
    assert full["rate_prior"] == "Tỷ lệ CTVLK PTM 2024 PSSL 2025"
    short = [naming.one_line_heading(h, params) for h in full.values()]
    assert short == [
        "STT", "PBH", "PTM25", "PTM24", "TỔNG SL CTVLK HH", "CTVLK PTM25 PS", "CTVLK PTM24 PS", "TỔNG SL CTVLK PS",
        "TL CTVLK PTM25", "TL CTVLK PTM24", "TL CTVLK PS", "SL ĐH Phát sinh", "SL ĐH PS Thành công", "Tỉ lệ ĐH Thành công",
    ]
    wrapped = naming.wrapped_headings(params)
    assert len(wrapped) == 14 and wrapped[full["order_rate"]] == "Tỉ lệ\nĐH Thành công"


def test_upper_headers(spark):
    assert naming.upper_headers(spark.range(1).toDF("pbh đ")).columns == ["PBH Đ"]


def test_columns_and_functions_agree_on_random_names(spark):
    rng = random.Random(3)
    scripts = [range(32, 127), range(0x80, 0x250), range(0x1E00, 0x1F00), range(0x300, 0x370), range(0x2000, 0x2070), range(0x660, 0x670), range(0x3000, 0x3100), range(9, 32)]
    names = ["".join(chr(rng.choice(rng.choice(scripts))) for _ in range(rng.randint(1, 8))) for _ in range(2000)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    found = df.select(
        "n", naming.ascii_name_column(F.col("n")), naming.unicode_name_column(F.col("n")), naming.table_column_column(F.col("n"), F.lit(5))
    )
    wrong = [r for r in found.collect() if tuple(r)[1:] != (naming.ascii_name(r.n), naming.unicode_name(r.n), naming.table_column(r.n, 5))]
    assert wrong == []
