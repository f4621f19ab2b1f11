"""Slices of equal size for parallel reading."""

import pytest
from pyspark.sql import functions as F

from partnerscope.sources import jdbc


def sizes(rows, slices):
    cuts = jdbc.slice_cuts(rows, "k", "s", slices)
    conditions = jdbc.slice_conditions(cuts, "k", "s")
    found = rows.agg(*[F.count_if(F.expr(c)).alias(f"c{i}") for i, c in enumerate(conditions)]).first()
    met = sum(F.expr(f"CASE WHEN {c} THEN 1 ELSE 0 END") for c in conditions)
    assert rows.where(met != 1).count() == 0
    return list(found)


@pytest.mark.parametrize(
    "key",
    [
        "id",  # all different
        "CASE WHEN id % 3 = 0 THEN 500 ELSE id END",  # one with a third of the rows
        "CASE WHEN id % 3 = 0 THEN 500 WHEN id % 3 = 1 THEN 501 ELSE id END",
        "id % 5",  # fewer keys than slices
        "7",
        "id * id * 1.5D",  # far from equal widths
        "-id",
    ],
)
@pytest.mark.parametrize("slices", [2, 7, 16])
def test_equal_slices(spark, key, slices):
    rows = spark.range(20_000).selectExpr(f"{key} AS k", "id AS s")
    found = sizes(rows, slices)
    assert len(found) == slices and sum(found) == 20_000
    assert max(found) <= 1.1 * min(found)


def test_many_slices_with_a_hot_key(spark):
    rows = spark.range(100_000).selectExpr("CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS k", "id AS s")
    found = sizes(rows, 200)
    assert len(found) == 200 and max(found) <= 1.1 * min(found)


@pytest.mark.parametrize("key", ["CASE WHEN id % 10 > 0 THEN id END", "CASE WHEN id % 5 > 1 THEN id END", "CASE WHEN id > 0 THEN id END"])
def test_missing_keys_are_cut_like_a_hot_one(spark, key):
    rows = spark.range(4_000).selectExpr(f"{key} AS k", "CASE WHEN id % 70 > 0 THEN id END AS s")
    found = sizes(rows, 8)
    assert len(found) == 8 and sum(found) == 4_000 and max(found) <= 1.1 * min(found)


def test_rows_that_cannot_be_told_apart_stay_together(spark):
    assert sizes(spark.range(1_000).selectExpr("3 AS k", "4 AS s"), 4).count(1_000) == 1
    assert sum(sizes(spark.range(1_000).selectExpr("3 AS k", "CAST(NULL AS INT) AS s"), 4)) == 1_000


def test_no_rows_and_one_slice(spark):
    rows = spark.range(3).selectExpr("id AS k", "id AS s")
    assert sizes(rows, 1) == [3] and sizes(rows.limit(0), 4) == [0]
    assert sum(sizes(rows.selectExpr("CAST(NULL AS INT) AS k", "s"), 4)) == 3
    with pytest.raises(ValueError, match="must be a slice"):
        jdbc.slice_cuts(rows, "k", "s", 0)


def test_no_more_than_a_few_rows_a_slice_come_back(spark):
    rows = spark.range(50_000).selectExpr("id AS k", "id AS s")
    assert len(jdbc.slice_cuts(rows, "k", "s", 8)) == 7
