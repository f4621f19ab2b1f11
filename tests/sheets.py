"""Workbooks made by hand for the tests: shared strings, styles, gaps."""

import io
import zipfile

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def book(sheet_rows, strings=(), formats="", styles=(0,), date1904=False, target="worksheets/data.xml"):
    """``sheet_rows`` is the inner XML of sheetData of the first of two sheets."""
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{OFFICE}"><workbookPr date1904="{int(date1904)}"/>'
        '<sheets><sheet name="One" sheetId="7" r:id="rId5"/><sheet name="Two" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}"><Relationship Id="rId1" Target="worksheets/other.xml"/>'
        f'<Relationship Id="rId5" Target="{target}"/></Relationships>',
        "xl/worksheets/data.xml": f'<worksheet xmlns="{MAIN}"><sheetData>{sheet_rows}</sheetData></worksheet>',
        "xl/worksheets/other.xml": f'<worksheet xmlns="{MAIN}"><sheetData/></worksheet>',
        "xl/styles.xml": f'<styleSheet xmlns="{MAIN}"><numFmts>{formats}</numFmts><cellXfs>'
        + "".join(f'<xf numFmtId="{n}"/>' for n in styles)
        + "</cellXfs></styleSheet>",
    }
    if strings:
        parts["xl/sharedStrings.xml"] = f'<sst xmlns="{MAIN}">' + "".join(strings) + "</sst>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return out.getvalue()
