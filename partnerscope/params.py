"""Report parameters: years, status texts, departments and text rules."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Department names, short codes and report order.
DEPARTMENTS = (
    ("Phòng bán hàng Bến Lức", "BLC", 1),
    ("Phòng bán hàng Cần Đước", "CĐC", 2),
    ("Phòng bán hàng Cần Giuộc", "CGC", 3),
    ("Phòng bán hàng Châu Thành", "CTH", 4),
    ("Phòng bán hàng Đức Hòa", "ĐHA", 5),
    ("Phòng bán hàng Đức Huệ", "ĐHE", 6),
    ("Phòng BHKV Kiến Tường - Mộc Hóa", "KTMH", 7),
    ("Phòng BHKV Tân An", "TAN", 8),
    ("Phòng bán hàng Thạnh Hóa", "THA", 9),
    ("Phòng bán hàng Tân Trụ", "TTU", 10),
    ("Phòng bán hàng Tân Thạnh", "TTH", 11),
    ("Phòng bán hàng Thủ Thừa", "TTA", 12),
    ("Phòng BHKV Vĩnh Hưng - Tân Hưng", "VHTH", 13),
)

# Status texts, label of the grand total row.
VERIFIED = "Đã xác thực"
SUCCESS = "Thành công"
TOTAL_LABEL = "TỔNG CỘNG"

# The table names of the two feeds.
PARTNER_TABLE = "danh_sach_ctv_dl"
ORDER_TABLE = "danhsachdonhang"


@dataclass(frozen=True)
class Department:
    name: str
    code: str
    ordinal: int


@dataclass(frozen=True)
class ReportParams:
    """Everything the report takes besides its two tables.

    ``typed_dates`` tests the year with a range on a date column (pushed to the
    scan) instead of looking for the year in the date text.  ``collation`` makes
    every text comparison, grouping and join follow a Spark collation.
    ``blank_as_null`` turns empty texts into NULL, so they are neither counted nor
    joined; by default an empty text is a value like any other.
    """

    departments: tuple[Department, ...]
    current_year: int
    prior_year: int
    verified: str = VERIFIED
    success: str = SUCCESS
    total_label: str = TOTAL_LABEL
    collation: str | None = None
    blank_as_null: bool = False
    typed_dates: bool = False
    as_of: dt.date | None = None

    def ordered_departments(self) -> tuple[Department, ...]:
        return tuple(sorted(self.departments, key=lambda d: d.ordinal))

    def report_date(self) -> dt.date:
        return self.as_of or dt.date.today()


def default_params(**changes) -> ReportParams:
    """The thirteen departments, reporting 2025 against 2024."""
    values = dict(
        departments=tuple(Department(*d) for d in DEPARTMENTS),
        current_year=2025,
        prior_year=2024,
    )
    values.update(changes)
    return ReportParams(**values)
