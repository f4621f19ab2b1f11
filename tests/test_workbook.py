import datetime as dt

import pytest
from sheets import book
from writer import make_workbook

from partnerscope.sources import feeds, workbook


def read(content):
    return [(n, cells, kinds) for n, cells, kinds in workbook.read_sheet(content)]


def test_made_workbook_reads_back():
    rows = [(1, "Ghi chú <&>", 2.5, True, dt.datetime(2025, 1, 2, 3, 4, 5)), (None, "", 3.0, False, None)]
    found = read(make_workbook(["a", None, "c", "d", "e"], rows))
    assert found == [
        (0, ["a", "", "c", "d", "e"], "s-sss"),
        (1, ["1", "Ghi chú <&>", "2.5", "1", "2025-01-02 03:04:05"], "isfbd"),
        (2, ["", "", "3", "0", ""], "--ib-"),
    ]


def test_shared_strings_gaps_and_blank_rows():
    strings = ["<si><t>h1</t></si>", "<si><r><t>h</t></r><r><t>3</t></r><rPh><t>x</t></rPh></si>", "<si><t>N/A</t></si>"]
    rows = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>'
        '<row r="4"><c r="B4"><v>7</v></c><c r="AB4" t="str"><f>A1</f><v>far</v></c></row>'
        '<row r="5"><c r="A5" t="s"><v>2</v></c><c r="B5" t="e"><v>#DIV/0!</v></c></row>'
        '<row r="9"/>'
    )
    found = read(book(rows, strings))
    assert [n for n, _, _ in found] == [0, 1, 2, 3]
    assert found[0][1] == ["h1", "", "h3"] and found[1][2] == "---"
    assert found[3][2][1] == "i" and found[3][1][27] == "far" and len(found[3][1]) == 28


def test_blank_row_kept_between_rows_only():
    rows = '<row r="1"><c t="inlineStr"><is><t>h</t></is></c></row><row r="3"><c><v>1</v></c></row><row r="4"><c/></row>'
    assert [(n, k) for n, _, k in read(book(rows))] == [(0, "s"), (1, "-"), (2, "i")]


def test_dates_by_style():
    formats = '<numFmt numFmtId="164" formatCode="[$-409]dd/mm/yyyy"/><numFmt numFmtId="165" formatCode="0.0 &quot;days&quot;"/>'
    rows = '<row r="1">' + "".join(
        f'<c r="{c}1" s="{s}"><v>{v}</v></c>' for c, s, v in [("A", 1, 45659), ("B", 2, 45659), ("C", 3, 45659.5), ("D", 0, 45659), ("E", 1, 0.25), ("F", 1, 59)]
    ) + '<c r="G1" t="d"><v>2025-01-02T00:00:00Z</v></c></row>'
    (_, cells, kinds), = read(book(rows, formats=formats, styles=(0, 164, 165, 22)))
    assert cells == ["2025-01-02 00:00:00", "45659", "2025-01-02 12:00:00", "45659", "06:00:00", "1900-02-28 00:00:00", "2025-01-02 00:00:00"]
    assert kinds == "didisdd"
    (_, cells, _), = read(book('<row r="1"><c s="1"><v>1.5</v></c></row>', styles=(0, 14), date1904=True, target="/xl/worksheets/data.xml"))
    assert cells == ["1904-01-02 12:00:00"]


def layout(spark, headers, rows, **options):
    files = spark.createDataFrame([("x.xlsx", bytearray(make_workbook(headers, rows)))], "path string, content binary")
    sheet = workbook.workbook_rows(files)
    columns = feeds.sheet_layout(sheet, **options)
    return columns, feeds.sheet_frame(sheet, columns)


NAMES = ["n", "f", "gap", "fgap", "z", "day", "dgap", "t", "mix", "b", "none"]
DAY = dt.datetime(2025, 1, 2)
ROWS = [
    (1, 1.5, 2, 2.5, 0, DAY, DAY, "x", 3, True, None),
    (2, 2.0, None, None, 4, DAY, None, "nan", "y", False, None),
]


def test_types(spark):
    columns, frame = layout(spark, NAMES, ROWS)
    text = feeds.TEXT_TYPE
    assert [c.type for c in columns] == ["int", "float", text, text, "int", "timestamp_ntz", "timestamp_ntz", text, text, text, text]
    found = [tuple(r) for r in frame.drop("path", "row_no").orderBy("n").collect()]
    assert found == [
        (1, 1.5, "2.0", "2.5", 0, DAY, DAY, "x", "3", "1", ""),
        (2, 2.0, "", "", 4, DAY, None, "", "y", "0", ""),
    ]


def test_tidy_and_wide_types(spark):
    columns, frame = layout(spark, NAMES, ROWS, tidy=True, wide=True)
    kinds = {c.name: c.type for c in columns}
    assert (kinds["n"], kinds["f"], kinds["z"]) == ("bigint", "double", feeds.TEXT_TYPE)
    assert sorted(r.z for r in frame.collect()) == ["", "4"]


def test_whole_number_too_large(spark):
    _, frame = layout(spark, ["n"], [(2**31,)])
    with pytest.raises(Exception, match="CAST|OVERFLOW"):
        frame.collect()
    _, frame = layout(spark, ["n"], [(2**31,)], wide=True)
    assert frame.first()["n"] == 2**31


def test_header_rules(spark):
    columns, _ = layout(spark, ["Họ Tên", None, "Họ Tên", "2 x"], [(1, 2, 3, 4)], rule="unicode")
    assert [c.name for c in columns] == ["họ_tên", "col_2", "họ_tên1", "col_2_x"]


def test_blank_header_row_and_blank_row_between(spark):
    rows = '<row r="2"><c r="A2"><v>1</v></c><c r="B2"><v>5</v></c></row><row r="4"><c r="A4"><v>2</v></c><c r="B4"><v>6</v></c></row>'
    files = spark.createDataFrame([("x.xlsx", bytearray(book(rows)))], "path string, content binary")
    sheet = workbook.workbook_rows(files)
    columns = feeds.sheet_layout(sheet)
    assert [(c.name, c.type) for c in columns] == [("col_1", feeds.TEXT_TYPE), ("col_2", feeds.TEXT_TYPE)]
    found = feeds.sheet_frame(sheet, columns).orderBy("row_no").collect()
    assert [(r.row_no, r.col_1, r.col_2) for r in found] == [(1, "1.0", "5.0"), (2, "", ""), (3, "2.0", "6.0")]


def test_sheets_must_agree(spark):
    files = [(f"{i}.xlsx", bytearray(make_workbook([h], [(1,)]))) for i, h in enumerate("ab")]
    sheet = workbook.workbook_rows(spark.createDataFrame(files, "path string, content binary"))
    with pytest.raises(ValueError, match="header"):
        feeds.sheet_layout(sheet)


def test_header_alone_and_nothing(spark):
    columns, frame = layout(spark, ["a", "b"], [])
    assert [c.name for c in columns] == ["a", "b"] and frame.count() == 0
    with pytest.raises(ValueError, match="no sheets"):
        feeds.sheet_layout(spark.createDataFrame([], workbook.ROWS_SCHEMA))


def test_rows_wider_than_the_header(spark):
    columns, frame = layout(spark, ["a"], [(1, "x"), (2, None)])
    assert [c.name for c in columns] == ["a", "col_2"]
    assert [(r.a, r.col_2) for r in frame.orderBy("a").collect()] == [(1, "x"), (2, "")]


def test_folder_of_workbooks(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.xlsx").write_bytes(make_workbook(["k", "v"], [(i * 10 + j, f"t{j}") for j in range(4)]))
    (tmp_path / "3.XLSX").write_bytes(make_workbook(["k", "v"], [(99, "capital")]))
    (tmp_path / "notes.txt").write_text("no sheet")
    rows = workbook.read_workbooks(spark, str(tmp_path))
    columns = feeds.sheet_layout(rows)
    frame = feeds.sheet_frame(rows, columns)
    assert frame.count() == 13 and [c.type for c in columns] == ["int", feeds.TEXT_TYPE]


def test_csv_feed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Mã,,Tên,Tên\n1,x,,y\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("Mã,,Tên,Tên\n2,,z,\n", encoding="utf-8")
    frame = feeds.read_csv_feed(spark, str(tmp_path), rule="unicode")
    assert frame.columns == ["mã", "col_2", "tên", "tên1"]
    assert sorted(tuple(r) for r in frame.collect()) == [("1", "x", "", "y"), ("2", "", "z", "")]


def test_csv_feed_with_line_breaks_and_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,,code\n"two\nlines",x,1\n', encoding="utf-8")
    found = feeds.read_csv_feed(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in found] == [("two\nlines", "x", "1")]
    (tmp_path / "b.csv").write_text("code,,name\n2,y,other\n", encoding="utf-8")
    with pytest.raises(Exception, match="CSV|header"):
        feeds.read_csv_feed(spark, str(tmp_path)).collect()


def test_header_reading_has_no_sorting(spark):
    rows = spark.createDataFrame([("p", 0, ["a", "b"], "ss"), ("p", 1, ["1", "0"], "ii")], workbook.ROWS_SCHEMA)
    seen = []
    plain = type(rows).collect
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(rows), "collect", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df))
        columns = feeds.sheet_layout(rows, tidy=True)
    assert [(c.name, c.type, c.text) for c in columns] == [("a", "int", "plain"), ("b", feeds.TEXT_TYPE, "tidy")]
    assert seen and all("SortAggregate" not in p for p in seen)


def test_frame_layout(spark):
    df = spark.createDataFrame(
        [(1, None, 0, 1.5, "nan", True, DAY), (2, 3, 5, 2.0, None, None, None)],
        "n long, gap int, z int, f double, t string, b boolean, d timestamp_ntz",
    )
    columns = feeds.frame_layout(df, tidy=True)
    assert [c.type for c in columns] == ["int", feeds.TEXT_TYPE, feeds.TEXT_TYPE, "float", feeds.TEXT_TYPE, feeds.TEXT_TYPE, "timestamp_ntz"]
    assert [tuple(r) for r in feeds.frame_to_load(df, columns).collect()] == [
        (1, "", "", 1.5, None, "1", DAY),
        (2, "3.0", "5", 2.0, "", "", None),
    ]
