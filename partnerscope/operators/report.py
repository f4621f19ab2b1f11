"""The partner report: one row per department present and one grand total.

Every count is a distinct count, and the total is not the sum of the groups: a
partner or an order seen in several departments counts once in the total. The
default form keeps, per partner code and per order id, the set of departments as
the bits of one number, so each key is shuffled once, every buffer has a fixed
size, and the department rows and the total come out of the same pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partnerscope.functions.literals import text_list
from partnerscope.functions.rates import rate_text
from partnerscope.operators.measures import (
    COUNTS,
    listed_partners,
    order_facts,
    success_codes,
    with_text_keys,
    year_orders,
)
from partnerscope.params import ReportParams

REPORT_COLUMNS = (
    "dept",
    "new_current",
    "new_prior",
    "existing",
    "active_current",
    "active_prior",
    "active_total",
    "rate_current",
    "rate_prior",
    "rate_overall",
    "orders_raised",
    "orders_ok",
    "order_rate",
)
NUMBERED_COLUMNS = ("stt",) + REPORT_COLUMNS[:11]

# Department bits and the total's bit share one 64-bit number.
MAX_BIT_DEPARTMENTS = 62


# ---------------------------------------------------------------- shared parts


def _total_pos(params: ReportParams) -> int:
    return len(params.departments)


def _summed(params: ReportParams, *parts: DataFrame, present: str = "listed") -> DataFrame:
    """Adds up rows of counts by position; a part lacks the counts it does not make.

    Positions without anything under ``present`` are left out. The total never is: a row
    of zeros stands for it, so it is there even on empty input.
    """
    total = _total_pos(params)
    rows = parts[0].sparkSession.range(1).selectExpr(f"{total} AS pos", *["0L"] * (len(COUNTS) + 1))
    for part in parts:
        counts = [f"CAST({c if c in part.columns else 0} AS bigint) AS {c}" for c in ("listed", *COUNTS)]
        rows = part.selectExpr("CAST(pos AS int) AS pos", *counts).union(rows)
    summed = rows.groupBy("pos").agg(*[F.expr(f"sum({c}) AS {c}") for c in ("listed", *COUNTS)])
    return summed.where(f"{present} > 0 OR pos = {total}")


def _labels(params: ReportParams) -> str:
    """Label of a position: the department's short code or the total's label."""
    labels = [d.code for d in params.ordered_departments()] + [params.total_label]
    return f"element_at(array({text_list(labels)}), pos + 1)"


def finish(counts: DataFrame, params: ReportParams) -> DataFrame:
    """Counts by position to report rows, with ``is_total`` and ``ord`` to sort by.

    The column ``existing`` means the current year in a department row, but either
    year in the total row.
    """
    is_total = f"pos = {_total_pos(params)}"
    active_total = "(active_current + active_prior)"
    return counts.selectExpr(
        f"{_labels(params)} AS dept",
        "new_current",
        "new_prior",
        f"CASE WHEN {is_total} THEN new_either ELSE new_current END AS existing",
        "active_current",
        "active_prior",
        f"{active_total} AS active_total",
        f"{rate_text('active_current', 'new_current')} AS rate_current",
        f"{rate_text('active_prior', 'new_prior')} AS rate_prior",
        f"{rate_text(active_total, 'new_either')} AS rate_overall",
        "orders_raised",
        "orders_ok",
        f"{rate_text('orders_ok', 'orders_raised')} AS order_rate",
        f"{is_total} AS is_total",
        "pos AS ord",
    )


def in_report_order(report: DataFrame) -> DataFrame:
    """Departments in their order, the total last. Few rows: one task sorts them, none are sampled."""
    return report.coalesce(1).orderBy("is_total", "ord")


# ------------------------------------------------------------- department bits


def _bit(params: ReportParams) -> str:
    """The department's bit plus the bit every listed row sets for the total."""
    if len(params.departments) > MAX_BIT_DEPARTMENTS:
        raise ValueError(f"more than {MAX_BIT_DEPARTMENTS} departments: use partner_report_two_level")
    return f"(shiftleft(1L, pos) | {1 << _total_pos(params)}L)"


def _count_bits(keys: DataFrame, params: ReportParams, key: str, counted: dict[str, str]) -> DataFrame:
    """Rows of counts by position from one row of bits per key.

    First counts the keys with the same bits. Keys sit in one or a few departments, so
    few rows are left, and each may stand for every position it has a bit for.
    """
    kinds = keys.groupBy(*[c for c in keys.columns if c != key]).agg(F.expr("count(1) AS n"))
    return _placed(kinds, params, {name: ("n", bits) for name, bits in counted.items()})


def _placed(kinds: DataFrame, params: ReportParams, counted: dict[str, tuple[str, str]]) -> DataFrame:
    """Each number once for every position that its bits have."""
    placed = kinds.selectExpr("*", f"explode(sequence(0, {_total_pos(params)})) AS pos")
    return placed.selectExpr("pos", *[f"{n} * getbit({bits}, pos) AS {name}" for name, (n, bits) in counted.items()])


def partner_bit_counts(
    partners: DataFrame, params: ReportParams, orders: DataFrame | None = None
) -> DataFrame:
    """Partner counts, to be summed by position. Activity needs the orders; else it is left out."""
    bit = _bit(params)
    bits = (
        listed_partners(partners, params)
        .groupBy("code")
        .agg(
            F.expr(f"bit_or({bit}) AS listed"),
            F.expr(f"bit_or(CASE WHEN is_current THEN {bit} ELSE 0L END) AS new_current"),
            F.expr(f"bit_or(CASE WHEN is_prior THEN {bit} ELSE 0L END) AS new_prior"),
        )
    )
    counted = {c: c for c in ("listed", "new_current", "new_prior")} | {"new_either": "new_current | new_prior"}
    if orders is not None:
        done = success_codes(orders, params).withColumn("active", F.lit(True))
        bits = bits.join(done, "code", "left")
        counted["active_current"] = "CASE WHEN active THEN new_current ELSE 0L END"
        counted["active_prior"] = "CASE WHEN active THEN new_prior ELSE 0L END"
    return _count_bits(bits, params, "code", counted)


def order_bit_counts(partners: DataFrame, orders: DataFrame, params: ReportParams) -> DataFrame:
    """Order counts, to be summed by position, for orders of verified partners."""
    owners = (
        listed_partners(partners, params)
        .where("verified")
        .groupBy("code")
        .agg(F.expr(f"bit_or({_bit(params)}) AS owner"))
    )
    # An order without id counts for nothing. Its bits go, not its row: a filter would reach the
    # scan, and the orders would be read once more for it.
    owned = "CASE WHEN ord_id IS NOT NULL THEN owner ELSE 0L END"
    per_order = (
        order_facts(orders, params)
        .join(owners, "code")
        .groupBy("ord_id")
        .agg(
            F.expr(f"bit_or({owned}) AS orders_raised"),
            F.expr(f"bit_or(CASE WHEN ok THEN {owned} ELSE 0L END) AS orders_ok"),
        )
    )
    return _count_bits(per_order, params, "ord_id", {c: c for c in ("orders_raised", "orders_ok")})


# ------------------------------------------------------------------ two levels


def partner_level_counts(
    partners: DataFrame, params: ReportParams, orders: DataFrame | None = None
) -> DataFrame:
    """Partner counts, to be summed by position: one row per department and code.

    The total needs one row per code, as a code may sit in several departments.
    """
    flags = ("is_current", "is_prior", "is_either", "active")
    per_dept = (
        listed_partners(partners, params)
        .groupBy("pos", "code")
        .agg(
            F.expr("max(int(is_current)) AS is_current"),
            F.expr("max(int(is_prior)) AS is_prior"),
            F.expr("max(int(is_current OR is_prior)) AS is_either"),
        )
    )
    if orders is None:
        joined = per_dept.withColumn("active", F.lit(0))
    else:
        done = success_codes(orders, params).withColumn("found", F.lit(1))
        joined = per_dept.join(done, "code", "left").selectExpr(*per_dept.columns, "coalesce(found, 0) AS active")
    per_code = joined.groupBy("code").agg(*[F.expr(f"max({f}) AS {f}") for f in flags])
    levels = joined.select("pos", *flags).union(per_code.selectExpr(f"{_total_pos(params)}", *flags))
    return levels.selectExpr(
        "pos",
        "1 AS listed",
        "is_current AS new_current",
        "is_prior AS new_prior",
        "is_either AS new_either",
        "is_current * active AS active_current",
        "is_prior * active AS active_prior",
    )


def order_level_counts(partners: DataFrame, orders: DataFrame, params: ReportParams) -> DataFrame:
    """Order counts, to be summed by position: one row per department and order id."""
    owners = listed_partners(partners, params).where("verified").select("pos", "code").distinct()
    joined = order_facts(orders, params).join(owners, "code")
    per_dept = joined.groupBy("pos", "ord_id").agg(F.expr("max(int(ok)) AS ok"))
    per_order = per_dept.groupBy("ord_id").agg(F.expr("max(ok) AS ok"))
    levels = per_dept.select("pos", "ok", "ord_id").union(per_order.selectExpr(f"{_total_pos(params)}", "ok", "ord_id"))
    raised = "CASE WHEN ord_id IS NULL THEN 0 ELSE 1 END"
    return levels.selectExpr("pos", f"{raised} AS orders_raised", f"ok * {raised} AS orders_ok")


# ---------------------------------------------------------------------- rollup


def _measure_rows(partners: DataFrame, orders: DataFrame, params: ReportParams) -> DataFrame:
    """Partner rows with activity, and their orders as further rows, both deduplicated.

    Deduplicated before the joins, so a partner's successful orders are not
    multiplied with all its orders.
    """
    per_dept = (
        listed_partners(partners, params)
        .groupBy("pos", "code")
        .agg(*[F.expr(f"bool_or({f}) AS {f}") for f in ("verified", "is_current", "is_prior")])
    )
    done = success_codes(orders, params).withColumn("found", F.lit(True))
    partner_rows = per_dept.join(done, "code", "left").selectExpr(
        "pos", "code", "is_current", "is_prior", "coalesce(found, false) AS active", "NULL AS ord_id", "false AS ok"
    )
    owners = per_dept.where("verified").select("pos", "code")
    order_rows = order_facts(orders, params).join(owners, "code").selectExpr(
        "pos", "NULL AS code", "false AS is_current", "false AS is_prior", "false AS active", "ord_id", "ok"
    )
    return partner_rows.union(order_rows)


# Report counts as distinct counts over those rows.
DISTINCT_COUNTS = (
    "count(DISTINCT CASE WHEN is_current THEN code END) AS new_current",
    "count(DISTINCT CASE WHEN is_prior THEN code END) AS new_prior",
    "count(DISTINCT CASE WHEN is_current OR is_prior THEN code END) AS new_either",
    "count(DISTINCT CASE WHEN is_current AND active THEN code END) AS active_current",
    "count(DISTINCT CASE WHEN is_prior AND active THEN code END) AS active_prior",
    "count(DISTINCT ord_id) AS orders_raised",
    "count(DISTINCT CASE WHEN ok THEN ord_id END) AS orders_ok",
)


# --------------------------------------------------------------- report forms


def partner_report(partners: DataFrame, orders: DataFrame, params: ReportParams) -> DataFrame:
    """The report, unordered; see ``in_report_order``.

    For at most 62 departments; ``partner_report_two_level`` takes any number.
    """
    partners, orders = with_text_keys(partners, orders, params)
    counts = partner_bit_counts(partners, params, orders), order_bit_counts(partners, orders, params)
    return finish(_summed(params, *counts), params)


def partner_report_two_level(partners: DataFrame, orders: DataFrame, params: ReportParams) -> DataFrame:
    """The same report for any number of departments, by two levels of grouping."""
    partners, orders = with_text_keys(partners, orders, params)
    counts = partner_level_counts(partners, params, orders), order_level_counts(partners, orders, params)
    return finish(_summed(params, *counts), params)


def partner_report_rollup(partners: DataFrame, orders: DataFrame, params: ReportParams) -> DataFrame:
    """The same report as one rollup of distinct counts over deduplicated rows."""
    partners, orders = with_text_keys(partners, orders, params)
    rows = _measure_rows(partners, orders, params)
    rolled = rows.rollup("pos").agg(F.expr("grouping(pos) AS is_total"), *map(F.expr, DISTINCT_COUNTS))
    placed = rolled.selectExpr(
        f"CASE WHEN is_total = 1 THEN {_total_pos(params)} ELSE pos END AS pos", "1 AS listed", *COUNTS
    )
    # A rollup of no rows has no total row; the sum adds it.
    return finish(_summed(params, placed), params)


def total_row(partners: DataFrame, orders: DataFrame, params: ReportParams) -> DataFrame:
    """The grand total alone, one row on any input: the report's row of the total's bit."""
    return partner_report(partners, orders, params).where("is_total")


def numbered_report(report: DataFrame) -> DataFrame:
    """Report rows numbered over the departments present; the total has no number."""
    place = F.row_number().over(Window.partitionBy("is_total").orderBy("ord")).cast("bigint")
    numbered = report.withColumn("stt", F.when(~F.col("is_total"), place))
    return numbered.select(*NUMBERED_COLUMNS, "is_total", "ord")


def in_number_order(numbered: DataFrame) -> DataFrame:
    """By row number, the row without one last."""
    return numbered.coalesce(1).orderBy(F.col("stt").asc_nulls_last())


# ------------------------------------------------------------ parts of a report


def new_partners(partners: DataFrame, params: ReportParams) -> DataFrame:
    """Newly registered and existing partners, from the partner table alone."""
    (partners,) = with_text_keys(partners, None, params)
    counts = _summed(params, partner_bit_counts(partners, params))
    return finish(counts, params).select(
        "dept", "new_current", "new_prior", "existing", "is_total", "ord"
    )


def active_partners(partners: DataFrame, orders: DataFrame, params: ReportParams) -> DataFrame:
    """Partners with a successful order this year, and the rates over new partners."""
    partners, orders = with_text_keys(partners, orders, params)
    counts = _summed(params, partner_bit_counts(partners, params, orders))
    return finish(counts, params).select(
        "dept",
        "active_current",
        "active_prior",
        "active_total",
        "rate_current",
        "rate_prior",
        "rate_overall",
        "is_total",
        "ord",
    )


def order_success(partners: DataFrame, orders: DataFrame, params: ReportParams) -> DataFrame:
    """Orders raised and successful; departments without orders are not listed."""
    partners, orders = with_text_keys(partners, orders, params)
    counts = _summed(params, order_bit_counts(partners, orders, params), present="orders_raised")
    return finish(counts, params).select(
        "dept", "orders_raised", "orders_ok", "order_rate", "is_total", "ord"
    )


def partner_activity(partners: DataFrame, orders: DataFrame, params: ReportParams) -> DataFrame:
    """Every listed partner with its orders of the year: how many, and whether one succeeded.

    The year test comes before the left join, so partners without orders stay.
    """
    partners, orders = with_text_keys(partners, orders, params)
    per_code = (
        order_facts(orders, params).groupBy("code").agg(F.expr("count(ord_id) AS n"), F.expr("bool_or(ok) AS good"))
    )
    joined = listed_partners(partners, params).join(per_code, "code", "left")
    return joined.selectExpr(
        f"{_labels(params)} AS dept",
        "code",
        "verified",
        "coalesce(n, 0) AS orders_raised",
        "coalesce(good, false) AS active",
    )


def join_sizes(partners: DataFrame, orders: DataFrame, params: ReportParams) -> DataFrame:
    """Rows per department of the report's two left joins, plain and deduplicated.

    The plain chain pairs every successful order of a partner with every order of
    the partner. Its size follows from counts per code, so no pair is made.
    ``plain_rows`` is a decimal, as the product outgrows 64 bits on hot codes.
    """
    partners, orders = with_text_keys(partners, orders, params)
    per_code = listed_partners(partners, params).groupBy("pos", "code").agg(F.expr("count(1) AS partner_rows"))
    order_rows = year_orders(orders, params).groupBy("code", "ord_id", "ok").agg(F.expr("count(1) AS n"))
    per_partner = order_rows.groupBy("code").agg(
        F.expr("sum(n) AS every"),
        F.expr("sum(CASE WHEN ok THEN n ELSE 0 END) AS good"),
        F.expr("count(1) AS single"),
    )
    wide = "decimal(18,0)"
    sizes = (
        per_code.join(per_partner, "code", "left")
        .selectExpr("pos", "partner_rows", *[f"greatest(coalesce({c}, 0), 1) AS {c}" for c in ("every", "good", "single")])
        .groupBy("pos")
        .agg(
            F.expr("sum(partner_rows) AS partner_rows"),
            F.expr(f"CAST(sum(CAST(partner_rows AS {wide}) * CAST(good AS {wide}) * CAST(every AS {wide})) AS decimal(38,0)) AS plain_rows"),
            F.expr("sum(partner_rows * single) AS distinct_rows"),
        )
    )
    return sizes.selectExpr(f"{_labels(params)} AS dept", "partner_rows", "plain_rows", "distinct_rows")
