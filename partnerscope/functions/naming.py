"""Header, column and table names.

Headers are a short list on the driver, so their rules are plain functions; the
same rules exist as column expressions for names held in data.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerscope.params import ReportParams

_D_WITH_STROKE = str.maketrans("đĐ", "dD")
_WHITE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def fill_blank_headers(headers: Sequence[str | None]) -> list[str]:
    """Blank headers get ``col_{position}``, counted from 1.

    A header repeated in the sheet gets ``.1``, ``.2``, … as sheet readers do.
    """
    seen: dict[str, int] = {}
    names = []
    for i, header in enumerate(headers, start=1):
        if header is None or header == "" or "Unnamed:" in header:
            names.append(f"col_{i}")
            continue
        repeat = seen.get(header, 0)
        seen[header] = repeat + 1
        names.append(header if repeat == 0 else f"{header}.{repeat}")
    return names


def _folded(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def ascii_name(name: str) -> str:
    """Lower case, spaces to ``_``, only ``a-z 0-9 _`` kept."""
    return re.sub(r"\W", "", _folded(name), flags=re.ASCII)


def unicode_name(name: str) -> str:
    """Lower case, spaces to ``_``, letters and digits of any script kept."""
    return re.sub(r"[^\w\s]", "", _folded(name))


def table_column(name: str, position: int) -> str:
    """A name usable in a table: no symbols, not empty, no leading digit."""
    plain = re.sub(r"\W", "", _folded(name))
    if not plain:
        return f"col_{position}"
    return re.sub(r"^(?=\d)", "col_", plain)


HEADER_RULES: dict[str, Callable[[str], str]] = {"ascii": ascii_name, "unicode": unicode_name}


def column_names(headers: Sequence[str | None], rule: str = "ascii", reserved: Sequence[str] = ()) -> list[str]:
    """Raw headers to unique table column names, by one rule for table and data.

    ``reserved`` names are not given out, such as that of the table's own id.
    """
    clean = HEADER_RULES[rule]
    names, taken = [], set(reserved)
    for i, header in enumerate(fill_blank_headers(headers), start=1):
        name = base = table_column(clean(header), i)
        copy = 2
        while name in taken:
            name, copy = f"{base}_{copy}", copy + 1
        taken.add(name)
        names.append(name)
    return names


def table_name(file_name: str) -> str:
    """A file name without folder and ending as a table name."""
    stem = re.sub(r"\.[^.]*$", "", re.split(r"[\\/]", file_name)[-1])
    return re.sub(r"\W", "", stem.lower())


def table_name_column(file_name: Column) -> Column:
    """The same for file names held in data."""
    stem = F.regexp_replace(F.regexp_extract(file_name, r"([^\\/]*)$", 1), r"\.[^.]*$", "")
    return F.regexp_replace(F.lower(stem), r"[^\p{L}\p{N}_]+", "")


def catalog_name(name: str) -> str:
    """A table name as the catalog takes it: accents dropped, ASCII letters, digits and ``_``."""
    bare = unicodedata.normalize("NFD", name.translate(_D_WITH_STROKE))
    return re.sub(r"\W", "", bare, flags=re.ASCII) or "sheet"


def _underscored(text: Column) -> Column:
    return F.replace(F.lower(F.trim(text, F.lit(_WHITE))), F.lit(" "), F.lit("_"))


def ascii_name_column(text: Column) -> Column:
    return F.regexp_replace(_underscored(text), r"\W+", "")  # ASCII only in Java


def unicode_name_column(text: Column) -> Column:
    return F.regexp_replace(_underscored(text), r"[^\p{L}\p{N}_\s\p{Z}\x1c-\x1f\x85]+", "")


def table_column_column(text: Column, position: Column) -> Column:
    plain = F.regexp_replace(_underscored(text), r"[^\p{L}\p{N}_]+", "")
    return (
        F.when(plain == "", F.concat(F.lit("col_"), position.cast("string")))
        .when(plain.rlike(r"^\p{Nd}"), F.concat(F.lit("col_"), plain))
        .otherwise(plain)
    )


def fill_blank_headers_column(headers: Column) -> Column:
    """The rule for blank and repeated headers on arrays of header texts."""

    def filled(header: Column, place: Column) -> Column:
        blank = header.isNull() | (header == "") | header.contains("Unnamed:")
        before = F.size(F.filter(F.slice(headers, F.lit(1), place), lambda h: h == header))
        repeated = F.when(before > 0, F.concat(header, F.lit("."), before.cast("string"))).otherwise(header)
        return F.when(blank, F.concat(F.lit("col_"), (place + 1).cast("string"))).otherwise(repeated)

    return F.transform(headers, filled)


def upper_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def report_headings(params: ReportParams) -> dict[str, str]:
    """Report column to its published heading."""
    now, before = params.current_year, params.prior_year
    # Headings of the published report.
    return {
        "stt": "STT",
        "dept": "PBH",
        "new_current": f"PTM{now}",
        "new_prior": f"PTM{before}",
        "existing": "TỔNG SL CTVLK Hiện hữu",
        "active_current": f"SL CTVLK PTM {now} PSSL {now}",
        "active_prior": f"SL CTVLK PTM {before} PSSL {now}",
        "active_total": f"TỔNG SL CTVLK PSSL {now}",
        "rate_current": f"Tỷ lệ CTVLK PTM {now} PSSL {now}",
        "rate_prior": f"Tỷ lệ CTVLK PTM {before} PSSL {now}",
        "rate_overall": f"Tỷ lệ CTVLK PSSL {now}",
        "orders_raised": "SL ĐH Phát sinh",
        "orders_ok": "SL ĐH PS Thành công",
        "order_rate": "Tỉ lệ ĐH Thành công",
    }


def wrapped_headings(params: ReportParams) -> dict[str, str]:
    """Published heading to the short heading of the picture, on two lines."""
    now, before = params.current_year, params.prior_year
    a, b = str(now)[-2:], str(before)[-2:]
    # Short headings.
    return {
        "PBH": "PBH",
        f"PTM{now}": f"PTM{a}",
        f"PTM{before}": f"PTM{b}",
        "TỔNG SL CTVLK Hiện hữu": "TỔNG SL\nCTVLK HH",
        f"SL CTVLK PTM {now} PSSL {now}": f"CTVLK\nPTM{a} PS",
        f"SL CTVLK PTM {before} PSSL {now}": f"CTVLK\nPTM{b} PS",
        f"TỔNG SL CTVLK PSSL {now}": "TỔNG SL\nCTVLK PS",
        f"Tỷ lệ CTVLK PTM {now} PSSL {now}": f"TL CTVLK\nPTM{a}",
        f"Tỷ lệ CTVLK PTM {before} PSSL {now}": f"TL CTVLK\nPTM{b}",
        f"Tỷ lệ CTVLK PSSL {now}": "TL\nCTVLK PS",
        "SL ĐH Phát sinh": "SL ĐH\nPhát sinh",
        "SL ĐH Thành công (Xác thực)": "SL ĐH\nThành công (Xác thực)",
        "SL ĐH PS Thành công": "SL ĐH\nPS Thành công",
        "Tỉ lệ ĐH Thành công": "Tỉ lệ\nĐH Thành công",
    }


def one_line_heading(heading: str, params: ReportParams) -> str:
    """Short heading found by the texts a published heading holds, in this order."""
    now, before = str(params.current_year), str(params.prior_year)
    year = before[-2:] if before in heading else now[-2:]
    # Texts looked for, and the short heading each gives.
    rules = (
        (heading == "TỔNG SL CTVLK Hiện hữu", "TỔNG SL CTVLK HH"),
        ("SL CTVLK PTM" in heading and "PSSL" in heading, f"CTVLK PTM{year} PS"),
        ("TỔNG SL CTVLK PSSL" in heading, "TỔNG SL CTVLK PS"),
        ("Tỷ lệ CTVLK PTM" in heading and "PSSL" in heading, f"TL CTVLK PTM{year}"),
        ("Tỷ lệ CTVLK PSSL" in heading, "TL CTVLK PS"),
        (f"PTM{now}" in heading, f"PTM{now[-2:]}"),
        (f"PTM{before}" in heading, f"PTM{before[-2:]}"),
    )
    return next((short for found, short in rules if found), heading)


def with_headings(df: DataFrame, params: ReportParams) -> DataFrame:
    return df.withColumnsRenamed(report_headings(params))


def with_wrapped_headings(df: DataFrame, params: ReportParams) -> DataFrame:
    return with_headings(df, params).withColumnsRenamed(wrapped_headings(params))


def with_one_line_headings(df: DataFrame, params: ReportParams) -> DataFrame:
    named = with_headings(df, params)
    return named.toDF(*[one_line_heading(c, params) for c in named.columns])
