"""The report from merged state against the report of all rows."""

import random

import pytest
from test_report import GOLDEN, ORDERS, PARTNERS, P, frames

from partnerscope.operators import incremental, report
from partnerscope.session import passing_folder


def lines(frame):
    return [tuple(r) for r in report.in_report_order(frame).select(*report.REPORT_COLUMNS).collect()]


def test_sample_in_two_batches(spark):
    with passing_folder(spark, "state") as place:
        state = incremental.ReportState(spark, place, P)
        partners, orders = frames(spark, PARTNERS, ORDERS)
        state.add("one", partners.limit(1), orders.limit(0))
        state.add("two", partners, orders)
        assert lines(state.report()) == GOLDEN
        state.add("two", partners, orders)
        state.add("three", orders=orders)
        assert lines(state.report()) == GOLDEN
        state.compact("all")
        assert state._batches("partners") == ["all"]
        assert lines(state.report()) == GOLDEN
        with pytest.raises(ValueError, match="already"):
            state.compact("all")


def test_no_rows(spark):
    with passing_folder(spark, "state") as place:
        state = incremental.ReportState(spark, place, P)
        state.add("none", *frames(spark, PARTNERS[:0], ORDERS[:0]))
        assert lines(state.report()) == lines(report.partner_report(*frames(spark, PARTNERS[:0], ORDERS[:0]), P))


def test_drawn_batches(spark):
    """Codes in several departments, orders with changing status and several codes, missing codes."""
    draw = random.Random(7)
    depts = [d.name for d in P.departments] + ["elsewhere", None]
    codes = [*"ABCDEFGH", "", None]
    done = ORDERS[0][3]
    partners = [(draw.choice(codes), draw.choice(depts), draw.choice([PARTNERS[0][2], "no", None]), draw.choice(["2025", "2024", "2025-2024", None])) for _ in range(60)]
    orders = [(draw.choice(codes), draw.choice(["1", "2", "3", "4", "5", None]), draw.choice(["2025", "2024"]), draw.choice([done, "no", None])) for _ in range(60)]
    whole = lines(report.partner_report(*frames(spark, partners, orders), P))
    with passing_folder(spark, "state") as place:
        state = incremental.ReportState(spark, place, P)
        for k in range(3):
            state.add(f"b{k}", *frames(spark, partners[k * 15 : k * 15 + 30], orders[k * 15 : k * 15 + 30]))
        assert lines(state.report()) == whole


def test_plan_reads_the_state_alone(spark):
    with passing_folder(spark, "state") as place:
        state = incremental.ReportState(spark, place, P)
        state.add("one", *frames(spark, PARTNERS, ORDERS))
        made = state.report()
        assert made.inputFiles() and all("/batch=one/" in f for f in made.inputFiles())
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "LogicalRDD" not in plan and "LocalRelation [col" not in plan
