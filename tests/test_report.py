import random

import pytest
from brute import ORDER_SCHEMA, PARTNER_SCHEMA, report as brute_report

from partnerscope import default_params
from partnerscope.operators import report
from partnerscope.operators.measures import collated_counts, department_code, order_view, partner_view
from partnerscope.params import Department
from partnerscope.plans import star_model

P = default_params()
BLC, CDC, CGC = (d.name for d in P.ordered_departments()[:3])
OK = P.verified
DONE = P.success
FORMS = [report.partner_report, report.partner_report_two_level, report.partner_report_rollup]

# The published sample: three partners, three orders.
PARTNERS = [("CTV001", BLC, OK, "2025"), ("CTV002", CDC, OK, "2024"), ("CTV003", CGC, OK, "2025")]
ORDERS = [("CTV001", "SP001", "2025", DONE), ("CTV002", "SP002", "2025", DONE), ("CTV003", "SP003", "2025", "Đang xử lý")]
GOLDEN = [
    ("BLC", 1, 0, 1, 1, 0, 1, "100.0%", "0.0%", "100.0%", 1, 1, "100.0%"),
    ("CĐC", 0, 1, 0, 0, 1, 1, "0.0%", "100.0%", "100.0%", 1, 1, "100.0%"),
    ("CGC", 1, 0, 1, 0, 0, 0, "0.0%", "0.0%", "0.0%", 1, 0, "0.0%"),
    ("TỔNG CỘNG", 2, 1, 3, 1, 1, 2, "50.0%", "100.0%", "66.7%", 3, 2, "66.7%"),
]


def frames(spark, partners, orders):
    return spark.createDataFrame(partners, PARTNER_SCHEMA), spark.createDataFrame(orders, ORDER_SCHEMA)


def rows(spark, form, partners, orders, params=P):
    made = report.in_report_order(form(*frames(spark, partners, orders), params))
    return [tuple(r) for r in made.select(*report.REPORT_COLUMNS).collect()]


def total(spark, partners, orders, params=P):
    return dict(zip(report.REPORT_COLUMNS, rows(spark, report.partner_report, partners, orders, params)[-1]))


@pytest.mark.parametrize("form", FORMS)
def test_sample(spark, form):
    assert rows(spark, form, PARTNERS, ORDERS) == GOLDEN


def test_total_row_alone(spark):
    made = report.total_row(*frames(spark, PARTNERS, ORDERS), P).select(*report.REPORT_COLUMNS)
    assert [tuple(r) for r in made.collect()] == GOLDEN[-1:]


def test_positional_views(spark):
    partners = spark.createDataFrame([(c, d, r, s) for c, d, s, r in PARTNERS], "col_3 string, col_14 string, col_17 string, col_22 string")
    orders = spark.createDataFrame([(c, t, s, i) for c, i, t, s in ORDERS], "col_12 string, col_25 string, col_27 string, col_3 string")
    made = report.in_report_order(report.partner_report(partner_view(partners), order_view(orders), P))
    assert [tuple(r) for r in made.select(*report.REPORT_COLUMNS).collect()] == GOLDEN


def test_code_in_two_departments_counts_once_in_total(spark):
    partners = [("A", BLC, OK, "2025"), ("A", CDC, OK, "2025")]
    made = rows(spark, report.partner_report, partners, [("A", "1", "2025", DONE)])
    assert [r[1] for r in made] == [1, 1, 1] and [r[10] for r in made] == [1, 1, 1]


def test_existing_means_either_year_in_total_only(spark):
    made = rows(spark, report.partner_report, [("A", BLC, OK, "2024")], [])
    assert [r[3] for r in made] == [0, 1]


def test_code_of_both_years_is_active_twice(spark):
    partners = [("A", BLC, OK, "2025"), ("A", BLC, OK, "2024")]
    assert total(spark, partners, [("A", "1", "2025", DONE)])["active_total"] == 2


@pytest.mark.parametrize("form", FORMS)
def test_many_orders_of_one_code(spark, form):
    orders = [("CTV001", f"X{i}", "2025", DONE if i < 3 else "x") for i in range(5)]
    once = rows(spark, form, PARTNERS, orders)
    assert once[0][10:12] == (5, 3)
    assert rows(spark, form, PARTNERS * 2, orders * 3) == once


@pytest.mark.parametrize("form", FORMS)
def test_empty_input_has_a_total(spark, form):
    zero = ("TỔNG CỘNG", 0, 0, 0, 0, 0, 0, "0.0%", "0.0%", "0.0%", 0, 0, "0.0%")
    assert rows(spark, form, [], []) == [zero]
    made = report.total_row(*frames(spark, [], []), P).select(*report.REPORT_COLUMNS)
    assert [tuple(r) for r in made.collect()] == [zero]


@pytest.mark.parametrize("form", FORMS)
def test_other_departments_are_left_out(spark, form):
    partners = PARTNERS + [("Z", "Phòng khác", OK, "2025"), ("Y", None, OK, "2025")]
    assert rows(spark, form, partners, ORDERS) == GOLDEN


def test_unlisted_department_has_no_code(spark):
    found = spark.createDataFrame([("Phòng khác",)], "dept string").select(department_code("dept", P)).first()
    assert found[0] is None


@pytest.mark.parametrize("form", FORMS)
def test_department_without_verified_partner_is_listed(spark, form):
    made = rows(spark, form, [("A", BLC, "x", "2025"), (None, CDC, OK, "2025")], [])
    assert [r[0] for r in made] == ["BLC", "CĐC", "TỔNG CỘNG"]
    assert all(r[1] == 0 for r in made)


@pytest.mark.parametrize("form", FORMS)
def test_blank_is_a_value_and_null_is_not(spark, form):
    partners = [("", BLC, OK, "2025"), ("", BLC, OK, "2025"), (None, BLC, OK, "2025")]
    orders = [("", "1", "2025", DONE), (None, "2", "2025", DONE), ("", None, "2025", DONE)]
    made = rows(spark, form, partners, orders)[0]
    assert made[1] == 1 and made[4] == 1 and made[10:12] == (1, 1)
    as_null = rows(spark, form, partners, orders, default_params(blank_as_null=True))[0]
    assert as_null[1] == 0 and as_null[10] == 0


def test_collation(spark):
    partners = [("a", BLC, "ĐÃ XÁC THỰC", "2025"), ("A", BLC, "Da xac thuc", "2025")]
    orders = [("A", "1", "2025", "THÀNH CÔNG")]
    assert total(spark, partners, orders)["new_current"] == 0
    same_case = total(spark, partners, orders, default_params(collation="UNICODE_CI"))
    assert (same_case["new_current"], same_case["active_current"], same_case["orders_ok"]) == (1, 1, 1)
    no_accent = total(spark, partners, orders, default_params(collation="UNICODE_CI_AI"))
    assert (no_accent["new_current"], no_accent["orders_ok"]) == (1, 1)


def test_collated_counts(spark):
    df = spark.createDataFrame([("Đã",), ("ĐÃ",), ("đã",), ("đã",), ("da",), (None,)], "t string")
    assert {tuple(r) for r in collated_counts(df, "t", "UTF8_LCASE").collect()} == {("ĐÃ", 4), ("da", 1), (None, 1)}
    assert {tuple(r) for r in collated_counts(df, "t", "UNICODE_CI_AI").select("n").collect()} == {(5,), (1,)}


def test_year_anywhere_in_text(spark):
    orders = [("CTV001", str(i), t, DONE) for i, t in enumerate(["2025-01-02", "02/01/2025", "X2025Y", "2024", None])]
    assert total(spark, PARTNERS, orders)["orders_raised"] == 3


def test_numbers_have_no_gaps(spark):
    names = [d.name for d in P.ordered_departments()]
    partners = [(c, names[i], OK, "2025") for c, i in (("A", 6), ("B", 0), ("C", 2))]
    made = report.numbered_report(report.partner_report(*frames(spark, partners, []), P))
    found = [(r.stt, r.dept) for r in report.in_number_order(made).collect()]
    assert found == [(1, "BLC"), (2, "CGC"), (3, "KTMH"), (None, "TỔNG CỘNG")]


def sample(seed, n_partners=60, n_orders=200):
    rng = random.Random(seed)
    names = [d.name for d in P.ordered_departments()] + ["Phòng khác", None]
    codes = [f"C{i}" for i in range(20)] + ["", None]
    partners = [
        (rng.choice(codes), rng.choice(names), rng.choice([OK, OK, "x", None]), rng.choice(["2025", "01/2024", "2023", "2024-2025", None]))
        for _ in range(n_partners)
    ]
    ids = [f"O{i}" for i in range(80)] + ["", None]
    # One code holds a third of the orders.
    orders = [
        ("C1" if rng.random() < 0.33 else rng.choice(codes), rng.choice(ids), rng.choice(["03/2025", "2025", "2024", None]), rng.choice([DONE, "x", None]))
        for _ in range(n_orders)
    ]
    return partners, orders


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("form", FORMS)
def test_forms_against_sets(spark, form, seed):
    partners, orders = sample(seed)
    assert rows(spark, form, partners, orders) == brute_report(partners, orders, P)


def test_partner_activity(spark):
    partners = PARTNERS + [(None, BLC, OK, "2025"), ("CTV009", BLC, "x", "2025"), ("Z", "Phòng khác", OK, "2025")]
    orders = ORDERS + [("CTV003", "SP003", "2025", DONE), ("CTV003", "SP004", "2024", DONE), (None, "SP9", "2025", DONE)]
    found = report.partner_activity(*frames(spark, partners, orders), P).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [
            ("BLC", "CTV001", True, 1, True),
            ("CĐC", "CTV002", True, 1, True),
            ("CGC", "CTV003", True, 1, True),
            ("BLC", None, False, 0, False),
            ("BLC", "CTV009", False, 0, False),
        ],
        key=str,
    )


def test_row_order_of_input_changes_nothing(spark):
    partners, orders = sample(5)
    assert rows(spark, report.partner_report, partners[::-1], orders[::-1]) == rows(spark, report.partner_report, partners, orders)


def test_beyond_62_departments_the_caller_takes_two_levels(spark):
    params = default_params(departments=tuple(Department(f"D{i}", f"d{i}", i) for i in range(70)))
    partners = [(f"C{i}", f"D{i % 70}", OK, "2025") for i in range(140)]
    assert rows(spark, report.partner_report_two_level, partners, [], params) == brute_report(partners, [], params)
    with pytest.raises(ValueError, match="two_level"):
        report.partner_report(*frames(spark, partners, []), params)


def test_62_departments_fit_the_bits(spark):
    params = default_params(departments=tuple(Department(f"D{i}", f"d{i}", i) for i in range(62)))
    partners = [(f"C{i % 9}", f"D{i}", OK, "2025") for i in range(62)]
    orders = [(f"C{i}", f"O{i}", "2025", DONE) for i in range(9)]
    assert rows(spark, report.partner_report, partners, orders, params) == brute_report(partners, orders, params)


def test_join_sizes(spark):
    partners = PARTNERS[:1] * 2
    orders = [("CTV001", f"X{i}", "2025", DONE if i < 3 else "x") for i in range(5)] * 2
    made = report.join_sizes(*frames(spark, partners, orders), P).first()
    assert tuple(made) == ("BLC", 2, 2 * 6 * 10, 2 * 5)
    assert made["plain_rows"].as_tuple().exponent == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, folder):
    partners, orders = star_model.star_partners(spark, folder), star_model.star_orders(spark, folder)
    for form in FORMS:
        text = plan(form(partners, orders, star_model.star_params()))
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    typed = plan(report.partner_report(partners, orders, star_model.star_params(typed_dates=True)))
    assert "GreaterThanOrEqual(o_orderdate" in typed and "o_totalprice" not in typed
    # Fixed-size buffers throughout: no sort-based or object-based aggregation.
    assert "SortAggregate" not in typed and "ObjectHashAggregate" not in typed and "Expand" not in typed


def executed(df):
    df.collect()
    return plan(df).split("Initial Plan")[0]


@pytest.mark.parametrize("form", [report.partner_report, report.total_row])
def test_orders_are_scanned_once(spark, folder, form):
    partners, orders = star_model.star_partners(spark, folder), star_model.star_orders(spark, folder)
    text = executed(form(partners, orders, star_model.star_params()))
    assert text.count("orders.parquet") == 1 and "Expand" not in text


def test_text_keys_under_a_collation(spark):
    params = default_params(collation="UTF8_LCASE")
    partners = [("Ab", BLC, OK, "2025"), ("aB", BLC, OK, "2025"), ("c", BLC, OK.upper(), "2024")]
    orders = [("AB", "O1", "2025", DONE), ("ab", "o1", "2025", DONE), ("C", "O2", "2025", "x")]
    made = report.partner_report(*frames(spark, partners, orders), params)
    dept = made.where("NOT is_total").first()
    assert (dept.new_current, dept.new_prior, dept.active_current, dept.orders_raised, dept.orders_ok) == (1, 1, 1, 2, 1)
    # Collated texts are sorted where spellings are compared, never to group or join rows.
    sorted_groups = [line for line in plan(made).splitlines() if "SortAggregate" in line]
    assert sorted_groups and all("_groupingexpression" in line or "_text" in line for line in sorted_groups)
