"""Plain one-sheet workbooks, written for the tests."""

import datetime as dt
import io
import re
import zipfile

import pandas as pd

from partnerscope.sources.workbook import MAIN, OFFICE


def _column_letters(index: int) -> str:
    letters = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        letters = chr(65 + rest) + letters
    return letters


def _escaped(text: str) -> str:
    kept = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", text)
    return kept.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _cell_xml(reference: str, value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return ""
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (dt.datetime, dt.date)):
        moment = value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())
        serial = (moment - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)
        return f'<c r="{reference}" s="1"><v>{serial!r}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{reference}"><v>{value!r}</v></c>'
    return f'<c r="{reference}" t="inlineStr"><is><t xml:space="preserve">{_escaped(str(value))}</t></is></c>'


def make_workbook(headers: list[str | None], rows: list[tuple]) -> bytes:
    """A one-sheet workbook of plain values; style 1 shows a date."""
    main = MAIN.strip("{}")
    office = OFFICE.strip("{}")
    package = "http://schemas.openxmlformats.org/package/2006"
    lines = []
    for number, row in enumerate([tuple(headers), *rows], start=1):
        cells = "".join(_cell_xml(f"{_column_letters(i)}{number}", v) for i, v in enumerate(row))
        lines.append(f'<row r="{number}">{cells}</row>')
    sheet_type = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{sheet_type}.sheet.main+xml"/>'
        f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{sheet_type}.worksheet+xml"/>'
        f'<Override PartName="/xl/styles.xml" ContentType="{sheet_type}.styles+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships">'
        f'<Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}">'
        '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships">'
        f'<Relationship Id="rId1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/>'
        f'<Relationship Id="rId2" Type="{office}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><fonts count="1"><font/></fonts>'
        '<fills count="1"><fill/></fills><borders count="1"><border/></borders>'
        '<cellStyleXfs count="1"><xf/></cellStyleXfs>'
        '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, xml in parts.items():
            book.writestr(name, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + xml)
    return out.getvalue()
