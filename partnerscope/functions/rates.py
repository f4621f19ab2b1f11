"""Rates as text, and the way back from text to a number, band or flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# Lower bound of each percent band and its background colour.
PERCENT_BANDS = (
    (80, "#4CAF50"),
    (60, "#A5D6A7"),
    (40, "#FFF59D"),
    (20, "#FFCC80"),
)
LOWEST_BAND_COLOUR = "#EF9A9A"


def rate_text(numerator: str, denominator: str) -> str:
    """SQL text of ``numerator / denominator`` in percent with one decimal; 0.0% over zero.

    Decimal arithmetic on whole numbers, half away from zero.
    """
    ratio = f"CAST({numerator} AS bigint) * 100.0 / nullif(CAST({denominator} AS bigint), 0)"
    return f"concat(CAST(round(coalesce({ratio}, 0), 1) AS string), '%')"


def number_or_null(text: Column) -> Column:
    """A decimal number written as text; NULL for anything else."""
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def percent_number(text: Column) -> Column:
    """``'66.7%'`` or ``'66,7%'`` to 66.7; NULL when there is no percent number."""
    plain = F.replace(F.replace(text, F.lit("%"), F.lit("")), F.lit(","), F.lit("."))
    return F.when(text.contains("%"), number_or_null(plain))


def percent_band(text: Column) -> Column:
    """Band 5 (from 80 up) down to 1 (below 20); NULL without a percent number."""
    return number_band(percent_number(text))


def number_band(number: Column) -> Column:
    """Band of a percent number; NULL for none."""
    band = F.when(number.isNull(), F.lit(None))
    for place, (bound, _) in enumerate(PERCENT_BANDS):
        band = band.when(number >= bound, F.lit(len(PERCENT_BANDS) + 1 - place))
    return band.otherwise(F.lit(1)).cast("int")


def band_colour(band: Column) -> Column:
    colours = [LOWEST_BAND_COLOUR] + [colour for _, colour in reversed(PERCENT_BANDS)]
    return F.when(band.isNotNull(), F.element_at(F.array(*[F.lit(c) for c in colours]), band))


def rate_above(text: Column, limit: float = 50.0) -> Column:
    """True for a rate over the limit; a dash or other text is never over it."""
    plain = F.regexp_replace(text, r"^%+|%+$", "")
    return F.coalesce((text != "-") & (number_or_null(plain) > F.lit(limit)), F.lit(False))
