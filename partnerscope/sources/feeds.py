"""Sheet rows and text exports to named, typed frames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partnerscope.functions.naming import column_names
from partnerscope.functions.values import (
    double_text,
    is_fractional,
    is_missing,
    null_for_load,
    number_tidy,
)

TEXT_TYPE = "varchar(255)"
# The column a loaded table numbers its rows with.
ID = "id"


@dataclass(frozen=True)
class LoadColumn:
    """A column to load: its place and name in the source, its name and type in the table."""

    source: int | str
    name: str
    type: str
    #: how values become text: plain, float (whole numbers as 2.0), tidy (no zeros)
    text: str = "plain"


def load_type(numbers: bool, whole: bool, dates: bool, blanks: bool, zeros: bool, tidy: bool, wide: bool) -> tuple[str, str]:
    """Table type and text form of a column from what its values are.

    A number column with a blank becomes text, and in the tidy form one with a zero
    too, because blanks are empty texts by the time the type is chosen.
    """
    if numbers and not blanks:
        if tidy and zeros:
            return TEXT_TYPE, "tidy"
        if whole:
            return ("bigint" if wide else "int"), "plain"
        return ("double" if wide else "float"), "plain"
    if numbers:
        return TEXT_TYPE, "float"
    if dates:
        return "timestamp_ntz", "plain"
    return TEXT_TYPE, "plain"


# ----------------------------------------------------------------- sheet rows


def sheet_layout(rows: DataFrame, rule: str = "ascii", tidy: bool = False, wide: bool = False) -> list[LoadColumn]:
    """Names and types of the columns of all sheets together.

    What is collected has a few rows per sheet column, of which the format allows 16,384.
    """
    headers = rows.where("row_no = 0").select(F.col("cells").alias("header")).distinct().limit(2).collect()
    if not headers:
        raise ValueError("there are no sheets to load")
    if len(headers) > 1:
        widest = max(len(h["header"]) for h in headers)
        texts = [[*h["header"], *[None] * (widest - len(h["header"]))] for h in headers]
        place = next(i for i, (a, b) in enumerate(zip(*texts, strict=True), start=1) if a != b)
        raise ValueError(f"the sheets disagree on the header of column {place}")
    # Rows of a sheet have few different rows of kinds: those are counted, then taken apart.
    zeros = F.transform("cells", lambda text, i: (text == "0") & (F.substring("kinds", i + 1, 1) == "i"))
    marked = F.concat_ws("", F.zip_with(F.split("kinds", ""), zeros, lambda kind, zero: F.when(zero, F.lit("0")).otherwise(kind)))
    rows_of = rows.where("row_no > 0").select(marked.alias("kinds")).groupBy("kinds").agg(F.count(F.lit(1)).alias("n"))
    cells = rows_of.select("n", F.posexplode(F.split("kinds", "")).alias("place", "kind"))
    found = cells.groupBy("place", "kind").agg(F.sum("n").alias("n")).collect()
    total = rows_of.agg(F.sum("n")).first()[0] or 0
    header = headers[0]["header"]
    kinds: list[dict[str, int]] = [{} for _ in range(max([len(header), *(r["place"] + 1 for r in found)]))]
    for row in found:
        kinds[row["place"]][row["kind"]] = row["n"]
    profiled = []
    for place, seen in enumerate(kinds):
        column = {k: seen.get(k, 0) > 0 for k in "fdbs"} | {"place": place, "n": sum(seen.values())}
        column |= {"i": seen.get("i", 0) + seen.get("0", 0) > 0, "zero": seen.get("0", 0) > 0, "blank": seen.get("-", 0) > 0}
        profiled.append(column)
    layout = []
    names = column_names([*header, *[None] * (len(kinds) - len(header))], rule, [ID])
    for column, name in zip(profiled, names, strict=True):
        text, number, date = column["s"] or column["b"], column["i"] or column["f"], column["d"]
        kind, form = load_type(
            numbers=number and not (text or date),
            whole=not column["f"],
            dates=date and not (text or number),
            blanks=column["blank"] or column["n"] < total,
            zeros=column["zero"],
            tidy=tidy,
            wide=wide,
        )
        layout.append(LoadColumn(column["place"], name, kind, form))
    return layout


def sheet_frame(rows: DataFrame, layout: list[LoadColumn]) -> DataFrame:
    """Data rows as named, typed columns, with ``path`` and ``row_no`` kept."""
    out = [F.col("path"), F.col("row_no")]
    for column in layout:
        text = F.coalesce(F.get("cells", F.lit(column.source)), F.lit(""))
        kind = F.substring("kinds", column.source + 1, 1)
        if column.type != TEXT_TYPE:
            value = F.when(text != "", text).cast(column.type)
        elif column.text == "float":
            value = F.when(kind == "i", F.concat(text, F.lit(".0"))).otherwise(text)
        elif column.text == "tidy":
            value = F.when((kind == "i") & (text == "0"), F.lit("")).otherwise(text)
        else:
            value = text
        out.append(value.alias(column.name))
    return rows.where(F.col("row_no") > 0).select(*out)


# --------------------------------------------------------------- other sources


def read_csv_feed(spark: SparkSession, path: str, rule: str = "ascii") -> DataFrame:
    """Text exports with a header line each; every column is text, blanks are empty texts.

    Quoted line breaks belong to their value. A file whose header differs from the first
    one's, also in the order of columns, is an error when its rows are read. Headers that
    repeat a name can't be compared and are taken by place.
    """
    reader = spark.read.option("multiLine", True)
    first = reader.option("header", False).csv(path).first()
    if first is None:
        raise ValueError(f"no rows under {path}")
    raw, names = [h or "" for h in first], column_names(list(first), rule)
    comparable = len({h.lower() for h in raw}) == len(raw)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (raw if comparable else names)])
    rows = reader.schema(schema).option("header", True).option("enforceSchema", not comparable).csv(path)
    return rows.toDF(*names).fillna("")


def frame_layout(df: DataFrame, rule: str = "ascii", tidy: bool = False, wide: bool = False) -> list[LoadColumn]:
    """The columns to load from a frame that has types, from one aggregate row."""
    figures = [F.lit(1).alias("one")]
    for i, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        figures.append(F.coalesce(F.bool_or(is_missing(column, field.dataType)), F.lit(False)).alias(f"blank_{i}"))
        number = isinstance(field.dataType, T.NumericType)
        zero = column == 0 if number else F.lit(False)
        figures.append(F.coalesce(F.bool_or(zero), F.lit(False)).alias(f"zero_{i}"))
    found = df.agg(*figures).first()
    names = column_names(df.columns, rule, [ID])
    layout = []
    for i, (field, name) in enumerate(zip(df.schema.fields, names)):
        kind, form = load_type(
            numbers=isinstance(field.dataType, T.NumericType),
            whole=isinstance(field.dataType, T.IntegralType),
            dates=isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)),
            blanks=found[f"blank_{i}"],
            zeros=found[f"zero_{i}"],
            tidy=tidy,
            wide=wide,
        )
        layout.append(LoadColumn(field.name, name, kind, form))
    return layout


def value_text(value: Column, data_type: T.DataType) -> Column:
    """A typed value as the text it is loaded as."""
    if is_fractional(data_type):
        return double_text(value.cast("double"))
    if isinstance(data_type, T.BooleanType):
        return value.cast("int").cast("string")
    return value.cast("string")


def frame_to_load(df: DataFrame, layout: list[LoadColumn], keep: Sequence[str] = ()) -> DataFrame:
    """A typed frame in its load form: blanks as empty texts, ``nan`` texts as NULL."""
    out = [F.col(c) for c in keep]
    for column in layout:
        data_type = df.schema[column.source].dataType
        value = F.col(f"`{column.source}`")
        if column.type != TEXT_TYPE:
            out.append(value.cast(column.type).alias(column.name))
            continue
        if column.text == "tidy":
            text = number_tidy(value)
        elif column.text == "float":
            text = double_text(value.cast("double"))
        else:
            text = value_text(value, data_type)
        filled = F.when(is_missing(value, data_type), F.lit("")).otherwise(text)
        out.append(null_for_load(filled).alias(column.name))
    return df.select(*out)


# ------------------------------------------------- feeds with differing headers

# Digits of the whole number types.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
WHOLE = tuple(DIGITS)


def _as_decimal(data_type: T.DataType) -> T.DecimalType:
    return data_type if isinstance(data_type, T.DecimalType) else T.DecimalType(DIGITS[type(data_type)], 0)


def common_type(first: T.DataType, second: T.DataType) -> T.DataType:
    """The narrowest type for the values of both: whole numbers, decimals, doubles, texts, in this order.

    Dates and timestamps meet in the timestamp. What else differs meets in text; nested types
    that differ have no type in common, which is an error.
    """
    if first == second or isinstance(second, T.NullType):
        return first
    if isinstance(first, T.NullType):
        return second
    if isinstance(first, WHOLE) and isinstance(second, WHOLE):
        return max(first, second, key=lambda t: DIGITS[type(t)])
    exact = (*WHOLE, T.DecimalType)
    if isinstance(first, exact) and isinstance(second, exact):
        a, b = _as_decimal(first), _as_decimal(second)
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if isinstance(first, T.NumericType) and isinstance(second, T.NumericType):
        return T.DoubleType()
    kinds = {type(first), type(second)}
    for stamp in (T.TimestampType, T.TimestampNTZType):
        if kinds == {T.DateType, stamp}:
            return stamp()
    nested = (T.ArrayType, T.MapType, T.StructType)
    if isinstance(first, nested) or isinstance(second, nested):
        raise ValueError(f"{first.simpleString()} and {second.simpleString()} have no type in common")
    return T.StringType()


def merged_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """Every column of the schemas, in the order they come, with a type for all its values.

    Names that differ in case only are one column, under the first spelling.
    """
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            known = found.get(field.name.lower())
            kind = common_type(known.dataType, field.dataType) if known else field.dataType
            found[field.name.lower()] = T.StructField(known.name if known else field.name, kind)
    return T.StructType(list(found.values()))


def merged_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with differing columns; a column that a frame lacks is NULL in its rows.

    Rows are neither moved nor compared. A frame without rows adds its columns; a name that one
    frame has twice is an error.
    """
    if not frames:
        raise ValueError("there are no frames to merge")
    for frame in frames:
        names = [c.lower() for c in frame.columns]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"a frame has several columns {', '.join(twice)}")
    schema = merged_schema([f.schema for f in frames])

    def shaped(frame: DataFrame) -> DataFrame:
        own = {field.name.lower(): field for field in frame.schema.fields}
        out = []
        for field in schema.fields:
            found = own.get(field.name.lower())
            value = F.lit(None) if found is None else F.col(f"`{found.name}`")
            if found is not None and isinstance(field.dataType, T.StringType):
                value = value_text(value, found.dataType)
            out.append(value.cast(field.dataType).alias(field.name))
        return frame.select(*out)

    return reduce(DataFrame.unionAll, [shaped(f) for f in frames])


def read_merged(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet feeds, each of one shape, as one frame; their shapes come from a file's footer each."""
    return merged_frames([spark.read.parquet(p) for p in paths])


def read_merged_csv(spark: SparkSession, paths: Sequence[str], rule: str = "ascii") -> DataFrame:
    """Text exports with a header each, which may differ from path to path; blanks are empty texts."""
    return merged_frames([read_csv_feed(spark, p, rule) for p in paths]).fillna("")
