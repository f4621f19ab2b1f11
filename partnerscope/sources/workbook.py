"""Spreadsheet workbooks as a Spark source.

``binaryFile`` lists and reads the files; each workbook is opened by one task and
streamed row by row. A task holds some compressed files (one Arrow batch of them), the
shared texts of the workbook it reads, and one batch of rows. The sheet format bounds a
workbook at 1,048,576 rows and 16,384 columns.

The functions that run in tasks stand in this module alone and are sent by value,
so executors need no copy of the package.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import sys
import zipfile
from collections.abc import Iterator
from decimal import Decimal
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# One row per sheet row. ``row_no`` 0 is the header. ``kinds`` has one letter per
# cell: i whole number, f other number, d date, b truth value, s text, - blank.
ROWS_SCHEMA = "path string, row_no bigint, cells array<string>, kinds string"
BATCH_ROWS = 20_000
#: Workbooks by the end of their name, in any case of letters.
WORKBOOK_FILES = "*.[xX][lL][sS][xX]"

# XML namespaces of the sheet format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
C, V, T, R, IS = (MAIN + tag for tag in ("c", "v", "t", "r", "is"))
OFFICE = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Numbers of the built-in date formats.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
# Cell texts read as missing.
MISSING = {
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
}


def _texts(node) -> str:
    """Text of a string item: its own or its runs', without phonetic hints."""
    runs = node.findall(R)
    if not runs:
        return node.findtext(T, "")
    return node.findtext(T, "") + "".join(r.findtext(T, "") for r in runs)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    items = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, node in ElementTree.iterparse(part):
            if node.tag == f"{MAIN}si":
                items.append(_texts(node))
                node.clear()
    return items


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dated = set(DATE_FORMATS)
    for fmt in root.iter(f"{MAIN}numFmt"):
        code = re.sub(r'"[^"]*"|\\.|_.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', "", fmt.get("formatCode", ""))
        number = int(fmt.get("numFmtId"))
        if re.search(r"[dmhys]", code.split(";")[0], re.IGNORECASE):
            dated.add(number)
        else:
            dated.discard(number)
    styles = root.find(f"{MAIN}cellXfs")
    return {
        i for i, xf in enumerate(styles if styles is not None else []) if int(xf.get("numFmtId", 0)) in dated
    }


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, bool]:
    """Part name of the first sheet, and whether dates count from 1904."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    sheet = root.find(f"{MAIN}sheets/{MAIN}sheet")
    properties = root.find(f"{MAIN}workbookPr")
    from_1904 = properties is not None and properties.get("date1904") in ("1", "true")
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(x.get("Target") for x in links if x.get("Id") == sheet.get(f"{OFFICE}id"))
    return (target.lstrip("/") if target.startswith("/") else f"xl/{target}"), from_1904


def _date_text(serial: float, from_1904: bool) -> str:
    """A day number as date and time; a number below 1 is a time of day."""
    base = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 30)
    moment = base + dt.timedelta(milliseconds=round(serial * 86_400_000))
    if 0 <= serial < 1 and not from_1904:
        return moment.time().isoformat()
    if 1 <= serial < 60 and not from_1904:
        moment += dt.timedelta(days=1)
    return moment.isoformat(sep=" ")


class _ColumnIndex(dict):
    """Place of a column by its letters, worked out once per column."""

    def __missing__(self, letters: str) -> int:
        index = 0
        for letter in letters:
            index = index * 26 + ord(letter.upper()) - 64
        self[letters] = index - 1
        return index - 1


def _cell(node, strings: list[str], dated: set[int], from_1904: bool) -> tuple[str, str]:
    """Kind and text of one cell."""
    kind = node.get("t", "n")
    if kind == "inlineStr":
        inline = node.find(IS)
        text = _texts(inline) if inline is not None else ""
    else:
        text = node.findtext(V, "")
        if kind == "s" and text:
            text = strings[int(text)]
    if kind == "e" or text in MISSING:
        return "-", ""
    if kind == "n":
        style = node.get("s")
        if style is not None and int(style) in dated:
            shown = _date_text(float(text), from_1904)
            return ("d" if "-" in shown else "s"), shown
        if text.lstrip("-").isdecimal():
            return "i", str(int(text))
        number = float(text)
        return ("i", str(int(number))) if number.is_integer() else ("f", format(Decimal(repr(number)), "f"))
    if kind == "b":
        return "b", "1" if text in ("1", "true") else "0"
    if kind == "d":
        moment = dt.datetime.fromisoformat(text.replace("Z", ""))
        return "d", moment.isoformat(sep=" ")
    return "s", text


def read_sheet(content: bytes) -> Iterator[tuple[int, list[str], str]]:
    """Rows of the first sheet: number, texts and kinds. Blank rows at the end are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings, dated = _shared_strings(book), _date_styles(book)
        part, from_1904 = _first_sheet(book)
        width, number, held, places = 0, -1, [], _ColumnIndex()
        with book.open(part) as sheet:
            steps = ElementTree.iterparse(sheet, ("start", "end"))
            parents = [next(steps)[1]]
            for step, node in steps:
                if node.tag == f"{MAIN}sheetData" and step == "start":
                    parents.append(node)
                if node.tag != f"{MAIN}row" or step == "start":
                    continue
                position = int(node.get("r", number + 2)) - 1
                cells: dict[int, tuple[str, str]] = {}
                for cell in node.iterfind(C):
                    reference = cell.get("r")
                    place = places[reference.rstrip("0123456789")] if reference else len(cells)
                    cells[place] = _cell(cell, strings, dated, from_1904)
                for parent in parents:  # rows that are done stay in neither the sheet nor its data
                    parent.clear()
                while number + 1 < position:
                    number += 1
                    held.append({})
                number = position
                held.append(cells)
                if all(kind == "-" for kind, _ in cells.values()) and number > 0:
                    continue
                for i, row in enumerate(held, start=number - len(held) + 1):
                    width = width or max(row, default=0) + 1
                    size = max(width, max(row, default=-1) + 1)
                    pairs = [row.get(c, ("-", "")) for c in range(size)]
                    yield i, [t for _, t in pairs], "".join(k for k, _ in pairs)
                held = []


def _open_workbooks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["path", "row_no", "cells", "kinds"]
    for files in batches:
        for path, content in zip(files["path"], files["content"]):
            rows = []
            for row in read_sheet(content):
                rows.append((path, *row))
                if len(rows) == BATCH_ROWS:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)


def workbook_rows(files: DataFrame) -> DataFrame:
    """Sheet rows of a frame of ``path, content``, batch or streaming."""
    return files.select("path", "content").mapInPandas(_open_workbooks, ROWS_SCHEMA)


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """Sheet rows of all workbooks in a folder or under a glob.

    A task gets some thirty small workbooks or a few large ones, as Spark counts 4 MB for
    opening a file (``spark.sql.files.openCostInBytes``); the bytes are not moved again.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", WORKBOOK_FILES).load(path)
    return workbook_rows(files)
