import datetime as dt

import pytest
from test_report import GOLDEN, ORDERS, PARTNERS
from writer import make_workbook

from partnerscope import default_params
from partnerscope.__main__ import main
from partnerscope.operators.report import REPORT_COLUMNS
from partnerscope.params import ORDER_TABLE, PARTNER_TABLE
from partnerscope.plans import jobs
from partnerscope.session import new_database
from partnerscope.sources import feeds

PARAMS = default_params(as_of=dt.date(2025, 5, 19))
MESSAGE = (
    "ĐIỂM TIN  KẾT QUẢ TRIỂN KHAI MÔ HÌNH CTV LIÊN KẾT NĂM 2025 (tính đến ngày 19/05/2025)\n"
    "- Số lượng CTV Liên kết phát triển mới: Tổng 2 CTV Liên kết. Trong đó:\n"
    "+ PBH đạt số lượng CTV cao nhất là: BLC (1), CGC (1), CĐC (0).\n"
    "- Tỷ lệ CTV LK PSSL năm 2025: Tỷ lệ chung đạt 66.7%. Trong đó:\n"
    "+ PBH đạt tỷ lệ cao nhất: BLC (100.0%), CĐC (100.0%), CGC (0.0%).\n"
    "+ PBH đạt tỷ lệ thấp nhất: CGC (0.0%), BLC (100.0%), CĐC (100.0%).\n"
)


@pytest.fixture
def feed_files(tmp_path):
    """The sample as sheets with 22 and 27 columns, only the used ones filled, most headers blank."""
    partner, order = tmp_path / "ctv.xlsx", tmp_path / "dh.xlsx"

    def put(width, values):
        return tuple(values.get(i) for i in range(1, width + 1))

    partner.write_bytes(make_workbook([None] * 22, [put(22, {3: c, 14: d, 17: t, 22: s}) for c, d, s, t in PARTNERS]))
    order.write_bytes(make_workbook([None] * 27, [put(27, {3: i, 12: c, 25: t, 27: s}) for c, i, t, s in ORDERS]))
    return str(partner), str(order)


def test_load_report_cleanup(spark, feed_files):
    database = new_database(spark, "job")
    delivered = []
    made = jobs.load_report_cleanup(spark, *feed_files, database, PARAMS, delivered.append, rule="unicode", tidy=True)
    assert [tuple(r) for r in made.report.select(*REPORT_COLUMNS).collect()] == GOLDEN
    assert made.message == MESSAGE and delivered == [made]
    assert not spark.catalog.tableExists(f"{database}.{PARTNER_TABLE}")


def test_tables_stay_when_delivery_fails(spark, feed_files):
    database = new_database(spark, "job")

    def fail(_):
        raise RuntimeError("not sent")

    with pytest.raises(RuntimeError, match="not sent"):
        jobs.load_report_cleanup(spark, *feed_files, database, PARAMS, fail)
    assert spark.catalog.tableExists(f"{database}.{ORDER_TABLE}")


def test_steps_one_by_one(spark, feed_files):
    database = new_database(spark, "job")
    assert jobs.upload_partners(spark, feed_files[0], database) == 3
    assert jobs.upload_orders(spark, feed_files[1], database) == 3
    assert jobs.upload_orders(spark, feed_files[1], database) == 3
    ids = [r.id for r in spark.table(f"{database}.{ORDER_TABLE}").orderBy("id").collect()]
    assert ids == [1, 2, 3, 4, 5, 6]
    made = jobs.generate_report(spark, database, PARAMS)
    assert [tuple(r) for r in made.report.select(*REPORT_COLUMNS).collect()] == GOLDEN
    assert [r[:2] for r in jobs.cleanup(spark, database)] == [(PARTNER_TABLE, True), (ORDER_TABLE, True)]


def test_load_sheet_default_names(spark, tmp_path):
    path = tmp_path / "Khách Hàng 1.xlsx"
    path.write_bytes(make_workbook(["Tên KH", "Số"], [("An", 1), ("Bình", 2)]))
    try:
        assert jobs.load_sheet(spark, str(path)) == ("excel_import.khachhang1", 2)
        assert [tuple(r) for r in spark.table("excel_import.khachhang1").orderBy("id").collect()] == [(1, "An", 1), (2, "Bình", 2)]
    finally:
        spark.sql("DROP DATABASE IF EXISTS excel_import CASCADE")


def test_query_then_drop(spark):
    database = new_database(spark, "job")
    spark.range(5).write.saveAsTable(f"{database}.t")
    seen = []
    query = f"SELECT count(*) AS n FROM {database}.t WHERE id >= :low"
    made = jobs.query_then_drop(spark, query, database, ["t"], lambda df: seen.append(df.first().n), low=2)
    assert seen == [3] and made.first().n == 3 and not spark.catalog.tableExists(f"{database}.t")


def test_empty_result_keeps_the_tables(spark):
    database = new_database(spark, "job")
    spark.range(5).write.saveAsTable(f"{database}.t")
    with pytest.raises(ValueError, match="no rows"):
        jobs.query_then_drop(spark, f"SELECT * FROM {database}.t WHERE id > 9", database, ["t"])
    assert spark.catalog.tableExists(f"{database}.t")


def test_run_query(spark):
    assert jobs.run_query(spark, None, "SELECT 1 AS a").first().a == 1
    assert jobs.run_query(spark, "SELECT :x AS a", x="y'").first().a == "y'"
    with pytest.raises(ValueError):
        jobs.run_query(spark)


def test_upload_new(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.xlsx").write_bytes(make_workbook(["x"], [("1",)]))
    layout = [feeds.LoadColumn(0, "x", feeds.TEXT_TYPE)]
    places = new_database(spark, "job"), "landed", str(tmp_path / "checkpoint")
    assert jobs.upload_new(spark, str(landing), *places, layout) == 1
    assert jobs.upload_new(spark, str(landing), *places, layout) == 0


def test_number_codes_with_gaps_on_one_side(spark, tmp_path):
    """Orders without partner make their code column text; it still meets the number codes."""
    database = new_database(spark, "job")

    def put(width, values):
        return tuple(values.get(i) for i in range(1, width + 1))

    partners = [put(22, {3: i + 1, 14: d, 17: dt.datetime(2025, 3, 1), 22: s}) for i, (_, d, s, _) in enumerate(PARTNERS)]
    orders = [put(27, {3: i, 12: c, 25: dt.datetime(2025, 4, 1), 27: "Thành công"}) for i, c in enumerate((1, 2, None, 1))]
    for name, rows, upload in (("p", partners, jobs.upload_partners), ("o", orders, jobs.upload_orders)):
        path = tmp_path / f"{name}.xlsx"
        path.write_bytes(make_workbook([None] * len(rows[0]), rows))
        upload(spark, str(path), database)
    made = jobs.generate_report(spark, database, PARAMS).report
    assert [(r.dept, r.new_current, r.active_current, r.orders_raised) for r in made.collect()] == [
        ("BLC", 1, 1, 2), ("CĐC", 1, 1, 1), ("CGC", 1, 0, 0), ("TỔNG CỘNG", 3, 2, 3),
    ]


def test_sheet_with_its_own_id(spark, tmp_path):
    database = new_database(spark, "job")
    path = tmp_path / "t.xlsx"
    path.write_bytes(make_workbook(["ID", "a"], [(7, "x")]))
    jobs.load_sheet(spark, str(path), database)
    assert spark.table(f"{database}.t").first().asDict() == {"id": 1, "id_2": 7, "a": "x"}


def test_sheet_without_rows(spark, tmp_path):
    database = new_database(spark, "job")
    path = tmp_path / "none.xlsx"
    path.write_bytes(make_workbook(["a", "b"], []))
    assert jobs.load_sheet(spark, str(path), database) == (f"{database}.none", 0)
    assert spark.table(f"{database}.none").columns == ["id", "a", "b"]


def test_headings_that_repeat_load_alike(spark, tmp_path):
    """The same name rule makes the table and the rows, so every column is filled."""
    database = new_database(spark, "job")
    path = tmp_path / "t.xlsx"
    path.write_bytes(make_workbook(["1 x", "!", "a", "A"], [(1, 2, 3, 4)]))
    jobs.load_sheet(spark, str(path), database)
    assert spark.table(f"{database}.t").first().asDict() == {"id": 1, "col_1_x": 1, "col_2": 2, "a": 3, "a_2": 4}


def test_command_line(spark, feed_files, tmp_path, capsys):
    database = new_database(spark, "job")
    main(["report", *feed_files, "--database", database, "--year", "2025"])
    shown = capsys.readouterr().out
    assert "TỔNG SL CTVLK Hiện hữu" in shown and "|KTMH" not in shown and "Tỷ lệ chung đạt 66.7%" in shown
    assert not spark.catalog.tableExists(f"{database}.{PARTNER_TABLE}")
    path = tmp_path / "Một.xlsx"
    path.write_bytes(make_workbook(["a"], [(1,), (2,)]))
    main(["load", str(path), "--database", database])
    assert f"2 rows added to {database}.mot" in capsys.readouterr().out
    path.write_bytes(make_workbook(["phone"], [(84901234567,)]))
    main(["load", str(path), "--database", database, "--table", "wide", "--wide", "--rule", "unicode"])
    assert spark.table(f"{database}.wide").first()["phone"] == 84901234567
    capsys.readouterr()
    main(["query", f"SELECT a, m.id FROM {database}.mot m CROSS JOIN range(125) r", "--database", database, "--drop", "mot", "--save-as", f"{database}.result"])
    shown = capsys.readouterr().out
    assert f"250 rows saved as {database}.result" in shown
    assert spark.table(f"{database}.result").count() == 250 and not spark.catalog.tableExists(f"{database}.mot")
    main(["query", f"SELECT * FROM {database}.result", "--database", database, "--drop", "result"])
    assert not spark.catalog.tableExists(f"{database}.result")
