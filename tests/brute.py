"""The report counted with plain sets, as a check on the Spark forms."""

from decimal import ROUND_HALF_UP, Decimal

PARTNER_SCHEMA = "code string, dept string, status string, reg_text string"
ORDER_SCHEMA = "code string, ord_id string, date_text string, status string"


def rate(a, b):
    value = Decimal(0) if b == 0 else Decimal(a) * 100 / Decimal(b)
    return f"{value.quantize(Decimal('0.1'), ROUND_HALF_UP)}%"


def _row(label, partners, orders, params, is_total):
    now, before = str(params.current_year), str(params.prior_year)
    verified = [p for p in partners if p[2] == params.verified and p[0] is not None]
    in_year = [o for o in orders if o[0] is not None and o[2] is not None and now in o[2]]
    good = {o[0] for o in in_year if o[3] == params.success}
    new_now = {p[0] for p in verified if p[3] is not None and now in p[3]}
    new_before = {p[0] for p in verified if p[3] is not None and before in p[3]}
    either = new_now | new_before
    owners = {p[0] for p in verified}
    raised = {o[1] for o in in_year if o[0] in owners and o[1] is not None}
    done = {o[1] for o in in_year if o[0] in owners and o[1] is not None and o[3] == params.success}
    active = (len(new_now & good), len(new_before & good))
    return (
        label,
        len(new_now),
        len(new_before),
        len(either if is_total else new_now),
        *active,
        sum(active),
        rate(active[0], len(new_now)),
        rate(active[1], len(new_before)),
        rate(sum(active), len(either)),
        len(raised),
        len(done),
        rate(len(done), len(raised)),
    )


def report(partners, orders, params):
    rows, listed = [], []
    for department in params.ordered_departments():
        members = [p for p in partners if p[1] == department.name]
        listed += members
        if members:
            rows.append(_row(department.code, members, orders, params, False))
    return rows + [_row(params.total_label, listed, orders, params, True)]
