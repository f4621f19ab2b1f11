"""Reports of bucketed and year-pruned tables against the report of the feeds."""

import random

import pytest
from pyspark.sql import functions as F
from test_incremental import lines
from test_report import GOLDEN, ORDERS, PARTNERS, P, frames

from partnerscope.operators import layout, report
from partnerscope.params import default_params
from partnerscope.session import passing_database


def laid_out(spark, database, partners, orders, buckets=4):
    made = layout.ReportTables(spark, database, buckets)
    made.load(partners, orders)
    return made


def drawn(seed, codes, ids):
    draw = random.Random(seed)
    depts = [d.name for d in P.departments] + ["elsewhere", None]
    partners = [
        (draw.choice(codes), draw.choice(depts), draw.choice([PARTNERS[0][2], "no", None]), draw.choice(["2025", "2024", "2024-2025", None]))
        for _ in range(80)
    ]
    dates = ["01/02/2025", "2024", "20250101", "120259", "2024-2025", "none", "", None]
    orders = [(draw.choice(codes), draw.choice(ids), draw.choice(dates), draw.choice([ORDERS[0][3], "no", None])) for _ in range(300)]
    return partners, orders


def test_sample(spark):
    with passing_database(spark, "layout") as database:
        assert lines(laid_out(spark, database, *frames(spark, PARTNERS, ORDERS)).report(P)) == GOLDEN


def test_no_rows(spark):
    feeds = frames(spark, PARTNERS[:0], ORDERS[:0])
    with passing_database(spark, "layout") as database:
        assert lines(laid_out(spark, database, *feeds).report(P)) == lines(report.partner_report(*feeds, P))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(
    ("codes", "ids"),
    [
        ([*"ABCDEFGH", "", None], [str(k) for k in range(40)] + [None]),  # most ids under several codes
        (["hot"] * 12 + [f"c{k}" for k in range(20)], [str(k) for k in range(5000)] + [None]),  # a third of all rows
    ],
)
def test_drawn_feeds(spark, seed, codes, ids):
    """Codes in several departments, hot codes, ids under several codes, repeats, missing values."""
    partners, orders = frames(spark, *drawn(seed, codes, ids))
    with passing_database(spark, "layout") as database:
        made = laid_out(spark, database, partners.unionAll(partners), orders.unionAll(orders), 6)
        assert lines(made.report(P)) == lines(report.partner_report(partners, orders, P))
        blank = default_params(blank_as_null=True)
        assert lines(made.report(blank)) == lines(report.partner_report(partners, orders, blank))


def test_hot_code_in_several_slots(spark):
    partners, orders = frames(spark, *drawn(1, ["hot"] * 12 + [f"c{k}" for k in range(20)], [str(k) for k in range(5000)]))
    with passing_database(spark, "layout") as database:
        laid_out(spark, database, partners, orders, 16)
        slots = spark.table(f"{database}.orders").groupBy("code").agg(F.count_distinct("_slot").alias("n"))
        assert {r["code"] for r in slots.where("n > 1").collect()} == {"hot"}


def test_other_columns_and_collation(spark):
    partners, orders = frames(spark, PARTNERS, ORDERS)
    with passing_database(spark, "layout") as database:
        made = laid_out(spark, database, partners.withColumn("n", F.lit(1)), orders.withColumn("pos", F.lit(2)).withColumn("dept", F.lit("x")))
        assert lines(made.report(P)) == GOLDEN
        assert {"pos", "dept"} <= set(spark.table(f"{database}.orders").columns)
        with pytest.raises(ValueError, match="collation"):
            made.report(default_params(collation="UNICODE_CI"))


def test_no_order_moves(spark):
    """Neither grouping nor join of the orders has an exchange; ids under several codes have folders."""
    partners, orders = frames(spark, PARTNERS, ORDERS)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    with passing_database(spark, "layout") as database:
        made = laid_out(spark, database, partners, orders)
        for key, value in settings.items():
            spark.conf.set(key, value)
        try:
            plan = made.within_buckets(P)._jdf.queryExecution().executedPlan().toString()
            across = made.across_buckets(P)._jdf.queryExecution().executedPlan().toString()
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(moved) == 2 and all("hot#" in line and "ord_id" not in line for line in moved)
    assert "PartitionFilters: [_year" in plan and "2025" in plan.split("PartitionFilters")[1]
    assert "Join" in plan and plan.index("Join") > plan.rindex("Exchange")  # the join is below both
    assert "_shared#" in across.split("PartitionFilters")[1]


def test_year_folders(spark):
    texts = ["15/03/1998", "19981999", "x1998y", "1998 1998", "1899", "2101", "", None, "12 34", "20240315", "99199"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(layout.year_folder(F.col("t"))).collect()
    assert [r[0] for r in found] == [1998, -1, 1998, 1998, 0, 0, 0, 0, 0, 2024, 0]


def test_only_folders_of_the_year_are_read(spark):
    orders = frames(spark, PARTNERS, [*ORDERS, ("A", "z", "2019", "no")])[1]
    with passing_database(spark, "layout") as database:
        layout.save_by_year(orders, f"{database}.orders")
        rows = spark.table(f"{database}.orders")
        assert any("_year=2019" in f for f in rows.inputFiles())
        plan = layout.of_year(rows, P)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [_year" in plan
        assert layout.of_year(rows, P).where("_year = 2019").count() == 0
        assert layout.of_year(rows, default_params(typed_dates=True)) is rows
