import random

import pytest
from brute import rate
from pyspark.sql import functions as F

from partnerscope.functions import rates, values


def texts(spark, items, function, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_rate_examples(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2469, 20000), (0, 0), (5, 0), (2, 3)], "a long, b long")
    assert [r[0] for r in df.select(F.expr(rates.rate_text("a", "b"))).collect()] == [
        "12.5%", "33.3%", "12.3%", "0.0%", "0.0%", "66.7%",
    ]


def test_rate_against_whole_numbers(spark):
    grid = spark.range(400).select(F.col("id").alias("a")).join(spark.range(250).select(F.col("id").alias("b")))
    a, b = F.col("a"), F.col("b")
    tenths = F.expr("(2000 * a + b) div (2 * nullif(b, 0))")
    text = F.coalesce(F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%")), F.lit("0.0%"))
    assert grid.where(F.expr(rates.rate_text("a", "b")) != text).count() == 0
    assert rate(2469, 20000) == "12.3%"


@pytest.mark.parametrize(
    "text, number, band",
    [("66.7%", 66.7, 4), ("100.0%", 100.0, 5), ("250%", 250.0, 5), ("79.9%", 79.9, 4), ("60%", 60.0, 4), ("-5%", -5.0, 1), ("66,7%", 66.7, 4), ("80%", 80.0, 5), ("40%", 40.0, 3), ("20.0%", 20.0, 2), ("0.0%", 0.0, 1), ("abc%", None, None), ("66.7", None, None), ("nan%", None, None), ("5d%", None, None), (None, None, None)],
)
def test_percent(spark, text, number, band):
    assert texts(spark, [text], rates.percent_number) == [number]
    assert texts(spark, [text], rates.percent_band) == [band]


def test_band_colour(spark):
    assert texts(spark, [5, 1, None], rates.band_colour, "v int") == ["#4CAF50", "#EF9A9A", None]


def test_rate_above(spark):
    assert texts(spark, ["50.0%", "50.1%", "-", "abc", None], rates.rate_above) == [False, True, False, False, False]


def test_number_tidy(spark):
    assert texts(spark, [None, float("nan"), 0.0, -0.0, 2.0, 2.5, 1e20, 12345678.25, 0.0005], values.number_tidy, "v double") == [
        "", "", "", "", "2", "2.5", "100000000000000000000", "12345678.25", "0.0005",
    ]
    assert texts(spark, [0, 7, None], values.number_tidy, "v int") == ["", "7", ""]


def test_tolerant_int(spark):
    assert texts(spark, ["12", " 3.9 ", "-4.2", "abc", "", None, "1e2", "5d", "1e30", "-9.3e18"], values.tolerant_int) == [12, 3, -4, 0, 0, 0, 100, 0, 0, 0]


def test_display_values(spark):
    assert texts(spark, [0, 5], values.zero_dash, "v long") == ["-", "5"]
    assert texts(spark, ["3.0", "3.5", None, "10"], values.drop_point_zero) == ["3", "3.5", "", "10"]
    assert texts(spark, ["", "4"], values.blank_as_zero) == ["0", "4"]
    assert texts(spark, ["nan", "", "x", None], values.null_for_load) == [None, "", "x", None]


def test_blank_fill(spark):
    df = spark.createDataFrame([(1, None, 2.0, None), (None, "x", float("nan"), True)], "a int, b string, c double, d boolean")
    assert [tuple(r) for r in values.blank_fill(df).collect()] == [("1", "", "2.0", ""), ("", "x", "", "true")]
    assert values.blank_fill(df, ["b"]).schema["a"].dataType.simpleString() == "int"


def test_double_text_on_random_numbers(spark):
    rng = random.Random(4)
    numbers = [rng.uniform(-1, 1) * 10 ** rng.uniform(-20, 14.9) for _ in range(2000)] + [round(rng.uniform(0, 1e9), 2) for _ in range(500)]
    numbers += [2e15, -1.5e300, 4e-300, 1e7, 1e-3]
    found = texts(spark, numbers, values.double_text, "v double")
    assert [float(t) for t in found] == numbers and not any("E" in t or "e" in t for t in found)
    plain = [(t, n) for t, n in zip(found, numbers) if 1e-4 <= abs(n) < 1e15]
    assert [t for t, _ in plain] == [repr(n) for _, n in plain]


def test_number_tidy_on_random_numbers(spark):
    rng = random.Random(5)
    numbers = [float(rng.randint(-(10**k), 10**k)) for k in range(16) for _ in range(40)] + [rng.randint(-9999, 9999) / 8 for _ in range(400)]
    expected = ["" if n == 0 else str(int(n)) if n.is_integer() else repr(n) for n in numbers]
    assert texts(spark, numbers, values.number_tidy, "v double") == expected
