"""Cell value rules: blanks, missing marks, numbers as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partnerscope.functions.rates import number_or_null


def is_fractional(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def is_missing(column: Column, data_type: T.DataType) -> Column:
    """NULL, or NaN where the type has one."""
    if is_fractional(data_type):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def _without_exponent(text: Column) -> Column:
    """A number in E notation as plain digits."""
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(F.regexp_replace(text, r"^-|\.|E.*$", ""), "(?<=.)0+$", "")
    power = F.regexp_extract(text, "E(-?[0-9]+)$", 1).cast("int")
    whole = F.rpad(F.substring(digits, F.lit(1), power + 1), power + 1, "0")
    rest = F.coalesce(F.nullif(F.substring(digits, power + 2, F.length(digits)), F.lit("")), F.lit("0"))
    large = F.concat(sign, whole, F.lit("."), rest)
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    return F.when(power >= 0, large).otherwise(small)


def double_text(column: Column) -> Column:
    """A double as plain digits with a point (``2.0``, ``0.00002``), whatever its size.

    The engine's text has the digits that tell the number from its neighbours; where it
    has them in E notation, the point is moved. Few numbers have: that part stands in a
    lambda, which keeps it out of the code compiled for every row.
    """
    text = column.cast("string")
    moved = F.element_at(F.transform(F.array(text), _without_exponent), 1)
    return F.when(text.contains("E"), moved).otherwise(text)


def blank_fill(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every missing value becomes an empty text; the columns become text."""
    chosen = set(columns or df.columns)
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name in chosen:
            text = double_text(column.cast("double")) if is_fractional(field.dataType) else column.cast("string")
            column = F.when(is_missing(column, field.dataType), F.lit("")).otherwise(text)
        out.append(column.alias(field.name))
    return df.select(*out)


def null_for_load(column: Column) -> Column:
    """Missing or the text ``nan`` is stored as NULL; an empty text stays."""
    return F.when(column != "nan", column)


def whole_number_text(column: Column) -> Column:
    """A whole double without its fraction: ``2.0`` to ``2``.

    Below 2^53 doubles are whole numbers one apart, so the number's own digits are those of its
    text as a double; they are only faster to get.
    """
    by_text = F.replace(double_text(column), F.lit(".0"), F.lit(""))
    return F.when(F.abs(column) < 2.0**53, column.cast("bigint").cast("string")).otherwise(by_text)


def number_tidy(column: Column) -> Column:
    """Missing or zero to an empty text, whole numbers without fraction."""
    number = column.cast("double")
    return (
        F.when(number.isNull() | F.isnan(number) | (number == 0), F.lit(""))
        .when(number == F.rint(number), whole_number_text(number))
        .otherwise(double_text(number))
    )


def tolerant_int(text: Column) -> Column:
    """A number in text cut to a whole one; anything else, and a number beyond 64 bits, counts as 0."""
    return F.coalesce(number_or_null(text.cast("string")).try_cast("bigint"), F.lit(0).cast("bigint"))


def zero_dash(number: Column) -> Column:
    """0 is shown as a dash."""
    return F.when(number == 0, F.lit("-")).otherwise(number.cast("string"))


def drop_point_zero(text: Column) -> Column:
    """``'3.0'`` to ``'3'``; missing to an empty text."""
    return F.coalesce(F.regexp_replace(text, r"\.0$", ""), F.lit(""))


def blank_as_zero(text: Column) -> Column:
    """An empty text counts as 0."""
    return F.when(text == "", F.lit("0")).otherwise(text)
