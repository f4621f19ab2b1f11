"""For each registered query the same result in plain SQL over the same tables."""

from __future__ import annotations

import textwrap

from partnerscope.operators.report import NUMBERED_COLUMNS, REPORT_COLUMNS
from partnerscope.plans.star_model import CURRENT_YEAR, PRIOR_YEAR, star_params

PARAMS = star_params()
TOTAL = PARAMS.total_label
NAMES = ", ".join(f"'{d.name}'" for d in PARAMS.ordered_departments())

PARTNERS = f"""
partner AS (
  SELECT c_custkey AS code, n_name AS dept,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'pending' ELSE 'verified' END AS status,
         '15/03/' || CAST({PRIOR_YEAR} + c_custkey % 3 AS VARCHAR) AS reg_text
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

EXTENDED = f"""
base_{PARTNERS.strip()},
partner AS (
  SELECT * FROM base_partner
  UNION ALL
  SELECT c_custkey, 'NATION_' || CAST(1 + c_custkey % 13 AS VARCHAR),
         CASE WHEN c_custkey % 2 = 0 THEN 'verified' ELSE 'pending' END,
         '01/01/' || CAST({PRIOR_YEAR} + c_custkey % 2 AS VARCHAR)
  FROM customer WHERE c_custkey % 3 = 0
  UNION ALL
  SELECT NULL, 'NATION_1', 'verified', '{CURRENT_YEAR}')"""

ORDERS = """
purchase AS (
  SELECT o_custkey AS code, o_orderkey AS ord_id, strftime(o_orderdate, '%d/%m/%Y') AS date_text,
         o_orderstatus AS status
  FROM orders)"""


def _rate(a: str, b: str) -> str:
    """Percent text with one decimal from whole numbers, half away from zero."""
    tenths = f"((2000 * ({a}) + ({b})) // (2 * ({b})))"
    return (
        f"CASE WHEN ({b}) = 0 THEN '0.0%' ELSE CAST({tenths} // 10 AS VARCHAR) || '.' "
        f"|| CAST({tenths} % 10 AS VARCHAR) || '%' END"
    )


def _blank(source: str, shown: str = "''") -> str:
    """The same rows with text codes, every tenth of them empty."""
    for key in ("c_custkey", "o_custkey"):
        text = f"CASE WHEN {key} % 10 = 0 THEN {shown} ELSE CAST({key} AS VARCHAR) END"
        source = source.replace(f"SELECT {key} AS code", f"SELECT {text} AS code")
    return source


# Both left joins as they stand, every order paired with every successful order.
LITERAL = f"""
joined AS (
  SELECT CAST(substr(p.dept, 8) AS INTEGER) AS ord, p.code AS code, p.status = 'verified' AS v,
         p.reg_text LIKE '%{CURRENT_YEAR}%' AS r1, p.reg_text LIKE '%{PRIOR_YEAR}%' AS r2,
         good.code AS good_code, every.ord_id AS ord_id, every.status AS ord_status,
         every.code AS every_code
  FROM partner p
  LEFT JOIN (SELECT code FROM purchase WHERE status = 'F' AND date_text LIKE '%{CURRENT_YEAR}%') good
    ON good.code = p.code
  LEFT JOIN (SELECT code, ord_id, status FROM purchase WHERE date_text LIKE '%{CURRENT_YEAR}%') every
    ON every.code = p.code
  WHERE p.dept IN ({NAMES})),
counted AS (
  SELECT grouping(ord) = 1 AS is_total, ord,
         count(DISTINCT CASE WHEN v AND r1 THEN code END) AS new_current,
         count(DISTINCT CASE WHEN v AND r2 THEN code END) AS new_prior,
         count(DISTINCT CASE WHEN v AND (r1 OR r2) THEN code END) AS new_either,
         count(DISTINCT CASE WHEN v AND r1 THEN good_code END) AS active_current,
         count(DISTINCT CASE WHEN v AND r2 THEN good_code END) AS active_prior,
         count(DISTINCT CASE WHEN v THEN ord_id END) AS orders_raised,
         count(DISTINCT CASE WHEN v AND ord_status = 'F' THEN ord_id END) AS orders_ok
  FROM joined GROUP BY ROLLUP (ord)),
report AS (
  SELECT CASE WHEN is_total THEN '{TOTAL}' ELSE 'N' || lpad(CAST(ord AS VARCHAR), 2, '0') END AS dept,
         new_current, new_prior,
         CASE WHEN is_total THEN new_either ELSE new_current END AS existing,
         active_current, active_prior, active_current + active_prior AS active_total,
         {_rate("active_current", "new_current")} AS rate_current,
         {_rate("active_prior", "new_prior")} AS rate_prior,
         {_rate("active_current + active_prior", "new_either")} AS rate_overall,
         orders_raised, orders_ok, {_rate("orders_ok", "orders_raised")} AS order_rate,
         is_total, ord
  FROM counted)"""

NUMBERED_CTE = """
numbered AS (
  SELECT CASE WHEN NOT is_total THEN row_number() OVER (PARTITION BY is_total ORDER BY ord) END AS stt, *
  FROM report)"""

REPORT = f"WITH {PARTNERS}, {ORDERS}, {LITERAL}"
NUMBERED_REPORT = f"{REPORT}, {NUMBERED_CTE}"
REPORT_LIST = ", ".join(REPORT_COLUMNS)
NUMBERED_LIST = ", ".join(NUMBERED_COLUMNS)
RATE_NUMBER = "CAST(replace(rate_overall, '%', '') AS DOUBLE)"


def _named(columns, names: dict[str, str]) -> str:
    return ", ".join(f'{c} AS "{names[c]}"' for c in columns)


def _listed(shown: str, order: str) -> str:
    return (
        f"(SELECT string_agg(dept || ' (' || CAST({shown} AS VARCHAR) || ')', ', ' ORDER BY rn) FROM "
        f"(SELECT *, row_number() OVER (ORDER BY {order}) AS rn FROM report WHERE NOT is_total) WHERE rn <= 3)"
    )


DIGEST = f"""
parts AS (
  SELECT CAST(coalesce((SELECT sum(new_current) FROM report WHERE NOT is_total), 0) AS BIGINT) AS total_new,
         {_listed("new_current", "new_current DESC, ord")} AS top_count,
         (SELECT rate_overall FROM report WHERE is_total) AS overall_rate,
         {_listed("rate_overall", RATE_NUMBER + " DESC, ord")} AS top_rate,
         {_listed("rate_overall", RATE_NUMBER + " ASC, ord")} AS bottom_rate)"""

# The headings expected for 1998 against 1997, published, on two lines, on one.
HEADINGS = {
    "stt": "STT",
    "dept": "PBH",
    "new_current": "PTM1998",
    "new_prior": "PTM1997",
    "existing": "TỔNG SL CTVLK Hiện hữu",
    "active_current": "SL CTVLK PTM 1998 PSSL 1998",
    "active_prior": "SL CTVLK PTM 1997 PSSL 1998",
    "active_total": "TỔNG SL CTVLK PSSL 1998",
    "rate_current": "Tỷ lệ CTVLK PTM 1998 PSSL 1998",
    "rate_prior": "Tỷ lệ CTVLK PTM 1997 PSSL 1998",
    "rate_overall": "Tỷ lệ CTVLK PSSL 1998",
    "orders_raised": "SL ĐH Phát sinh",
    "orders_ok": "SL ĐH PS Thành công",
    "order_rate": "Tỉ lệ ĐH Thành công",
}
WRAPPED = {
    "stt": "STT",
    "dept": "PBH",
    "new_current": "PTM98",
    "new_prior": "PTM97",
    "existing": "TỔNG SL\nCTVLK HH",
    "active_current": "CTVLK\nPTM98 PS",
    "active_prior": "CTVLK\nPTM97 PS",
    "active_total": "TỔNG SL\nCTVLK PS",
    "rate_current": "TL CTVLK\nPTM98",
    "rate_prior": "TL CTVLK\nPTM97",
    "rate_overall": "TL\nCTVLK PS",
    "orders_raised": "SL ĐH\nPhát sinh",
    "orders_ok": "SL ĐH\nPS Thành công",
    "order_rate": "Tỉ lệ\nĐH Thành công",
}
ONE_LINE = {
    "stt": "STT",
    "dept": "PBH",
    "new_current": "PTM98",
    "new_prior": "PTM97",
    "existing": "TỔNG SL CTVLK HH",
    "active_current": "CTVLK PTM98 PS",
    "active_prior": "CTVLK PTM97 PS",
    "active_total": "TỔNG SL CTVLK PS",
    "rate_current": "TL CTVLK PTM98",
    "rate_prior": "TL CTVLK PTM97",
    "rate_overall": "TL CTVLK PS",
    "orders_raised": "SL ĐH Phát sinh",
}


def _dash(column: str) -> str:
    return f"CASE WHEN {column} = 0 THEN '-' ELSE CAST({column} AS VARCHAR) END"


def _shown(column: str) -> str:
    if column == "stt":
        return "coalesce(CAST(stt AS VARCHAR), '')"
    if column == "dept":
        return f"CASE WHEN is_total THEN replace('{TOTAL}', ' ', chr(10)) ELSE dept END"
    return column if column.startswith("rate_") else _dash(column)


def _cells(columns, text, source: str, names: dict[str, str]) -> str:
    rows = [
        f"SELECT CAST(row_number() OVER (ORDER BY is_total, ord) - 1 AS INTEGER) AS \"row\", is_total, "
        f"{i} AS col, '{c}' AS name, '{names[c]}' AS heading, CAST({text(c)} AS VARCHAR) AS text FROM {source}"
        for i, c in enumerate(columns)
    ]
    return "cell AS (" + " UNION ALL ".join(rows) + ")"


def _band(number: str) -> str:
    return (
        f"CASE WHEN {number} >= 80 THEN '#4CAF50' WHEN {number} >= 60 THEN '#A5D6A7' "
        f"WHEN {number} >= 40 THEN '#FFF59D' WHEN {number} >= 20 THEN '#FFCC80' ELSE '#EF9A9A' END"
    )


CELL_NUMBER = "CAST(replace(text, '%', '') AS DOUBLE)"
PERCENT_TEXT = (
    "CAST(CAST(l_quantity AS INTEGER) * 2 AS VARCHAR) || CASE WHEN l_orderkey % 2 = 0 THEN '.' ELSE ',' END"
    " || CAST(l_linenumber AS VARCHAR) || '%'"
)
PARTS_IN_ORDER = "partner p WHERE p.dept IN (" + NAMES + ")"
STRIPPED = r"regexp_replace(text, '^[\s\x{1c}-\x{1f}\x{85}\p{Z}]+|[\s\x{1c}-\x{1f}\x{85}\p{Z}]+$', '', 'g')"
FOLDED = f"replace(lower({STRIPPED}), ' ', '_')"


def _profile_part(table: str, columns: list[tuple[str, str]]) -> str:
    rows = []
    for i, (name, kind) in enumerate(columns, start=1):
        longest = f"(SELECT CAST(max(length({name})) AS INTEGER) FROM {table})" if kind == "string" else "CAST(NULL AS INTEGER)"
        rows.append(
            f"SELECT '{table}' AS table_name, {i} AS position, '{name}' AS column_name, '{kind}' AS data_type, "
            f"(SELECT count(*) FROM {table}) AS total_rows, "
            f"(SELECT count(*) FROM {table} WHERE {name} IS NULL) AS null_count, {longest} AS longest_text"
        )
    return " UNION ALL ".join(rows)


PROFILED = {
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")],
}


NUMBERS = ("int", "bigint", "double")

# Types of loaded columns where they differ from the source's.
LOADED = {"string": "varchar(255)", "int": "bigint"}


def _tidy(number: str) -> str:
    return (
        f"CASE WHEN {number} = 0 THEN '' WHEN {number} = floor({number}) "
        f"THEN CAST(CAST({number} AS BIGINT) AS VARCHAR) ELSE CAST({number} AS VARCHAR) END"
    )


def _nums() -> str:
    return "CASE WHEN p_size % 3 <> 2 THEN 0 ELSE CAST(floor(CAST(replace(p_brand, 'Brand#', '') AS DOUBLE) + 0.75) AS BIGINT) END"


def oracle() -> dict[str, str]:
    published = f"{REPORT} SELECT {REPORT_LIST} FROM report"
    statements = {
        "partner_report": published,
        "partner_report_rollup": published,
        "partner_report_two_level": published,
        "partner_report_typed": published,
        "loaded_report": published,
        "report_incremental": published,
        "partner_report_pruned": published,
        "bucketed_report": f"WITH {EXTENDED}, {ORDERS}, {LITERAL} SELECT {REPORT_LIST} FROM report",
        "partner_report_text_codes": published,
        "partner_report_collated": published,
        "partner_report_blank_codes": f"WITH {_blank(PARTNERS)}, {_blank(ORDERS)}, {LITERAL} SELECT {REPORT_LIST} FROM report",
        "partner_report_blank_as_null": f"""WITH {_blank(PARTNERS, "NULL")}, {_blank(ORDERS, "NULL")}, {LITERAL}
            SELECT {REPORT_LIST} FROM report""",
        "partner_activity": f"""WITH {PARTNERS}, {ORDERS}
            SELECT 'N' || lpad(substr(p.dept, 8), 2, '0') AS dept, p.code, p.status = 'verified' AS verified,
                   count(DISTINCT o.ord_id) AS orders_raised, coalesce(bool_or(o.status = 'F'), false) AS active
            FROM partner p LEFT JOIN (SELECT * FROM purchase WHERE date_text LIKE '%{CURRENT_YEAR}%') o ON o.code = p.code
            WHERE p.dept IN ({NAMES}) GROUP BY 1, 2, 3""",
        "text_total": """SELECT CAST(sum(CASE WHEN l_returnflag = 'N' THEN 0 ELSE CAST(l_quantity AS INTEGER) END) AS BIGINT) AS total
            FROM lineitem""",
        "partner_report_shared_codes": f"WITH {EXTENDED}, {ORDERS}, {LITERAL} SELECT {REPORT_LIST} FROM report",
        "partner_report_numbered": f"{NUMBERED_REPORT} SELECT {NUMBERED_LIST} FROM numbered",
        "partner_total_only": f"{REPORT} SELECT {REPORT_LIST} FROM report WHERE is_total",
        "report_headings": f"{REPORT} SELECT {_named(REPORT_COLUMNS, HEADINGS)} FROM report",
        "report_wrapped_headings": f"{REPORT} SELECT {_named(REPORT_COLUMNS, WRAPPED)} FROM report",
        "report_one_line_headings": f"{NUMBERED_REPORT} SELECT {_named(NUMBERED_COLUMNS, ONE_LINE)} FROM numbered",
        "report_upper_headers": f"{REPORT} SELECT {_named(REPORT_COLUMNS, {c: c.upper() for c in REPORT_COLUMNS})} FROM report",
        "new_partners_by_dept": f"{REPORT} SELECT dept, new_current, new_prior, existing FROM report",
        "active_partners_by_dept": f"{REPORT} SELECT dept, active_current, active_prior, active_total FROM report",
        "conversion_rates": f"{REPORT} SELECT dept, rate_current, rate_prior, rate_overall FROM report",
        "order_success_rate": f"""{REPORT} SELECT dept, orders_raised, orders_ok, order_rate FROM report
            WHERE is_total OR orders_raised > 0""",
        "partner_orders_fanout": f"""{REPORT},
            slim AS (SELECT DISTINCT code, ord_id, status FROM purchase WHERE date_text LIKE '%{CURRENT_YEAR}%')
            SELECT 'N' || lpad(substr(p.dept, 8), 2, '0') AS dept,
                   CAST(count(*) AS BIGINT) AS distinct_rows,
                   CAST(max(big.plain_rows) AS DECIMAL(38,0)) AS plain_rows,
                   CAST(max(base.partner_rows) AS BIGINT) AS partner_rows
            FROM partner p LEFT JOIN slim ON slim.code = p.code
            JOIN (SELECT ord, count(*) AS plain_rows FROM joined GROUP BY ord) big ON big.ord = CAST(substr(p.dept, 8) AS INTEGER)
            JOIN (SELECT dept, count(*) AS partner_rows FROM partner GROUP BY dept) base ON base.dept = p.dept
            WHERE p.dept IN ({NAMES}) GROUP BY p.dept""",
        "nulls_last_order": f"""{NUMBERED_REPORT} SELECT stt, dept, existing,
            CAST(CASE WHEN stt IS NULL THEN 999999 ELSE stt END AS BIGINT) AS sort_key FROM numbered""",
        "union_total_last": f"""{REPORT} SELECT CAST(ord - 1 AS BIGINT) AS ord, dept, new_current FROM report""",
        "top3_by_count": f"""{REPORT} SELECT dept, new_current FROM report WHERE NOT is_total
            ORDER BY new_current DESC, ord LIMIT 3""",
        "top3_by_rate": f"""{REPORT} SELECT dept, rate_overall FROM report WHERE NOT is_total
            ORDER BY {RATE_NUMBER} DESC, ord LIMIT 3""",
        "bottom3_by_rate": f"""{REPORT} SELECT dept, rate_overall FROM report WHERE NOT is_total
            ORDER BY {RATE_NUMBER} ASC, ord LIMIT 3""",
        "digest_parts": f"{REPORT}, {DIGEST} SELECT * FROM parts",
        "digest_message": f"""{REPORT}, {DIGEST} SELECT
            'ĐIỂM TIN  KẾT QUẢ TRIỂN KHAI MÔ HÌNH CTV LIÊN KẾT NĂM {CURRENT_YEAR} (tính đến ngày 31/12/{CURRENT_YEAR})' || chr(10)
            || '- Số lượng CTV Liên kết phát triển mới: Tổng ' || CAST(total_new AS VARCHAR) || ' CTV Liên kết. Trong đó:' || chr(10)
            || '+ PBH đạt số lượng CTV cao nhất là: ' || top_count || '.' || chr(10)
            || '- Tỷ lệ CTV LK PSSL năm {CURRENT_YEAR}: Tỷ lệ chung đạt ' || overall_rate || '. Trong đó:' || chr(10)
            || '+ PBH đạt tỷ lệ cao nhất: ' || top_rate || '.' || chr(10)
            || '+ PBH đạt tỷ lệ thấp nhất: ' || bottom_rate || '.' || chr(10) AS message FROM parts""",
        "zero_dash_display": f"""{NUMBERED_REPORT} SELECT
            {", ".join(f"{_shown(c)} AS {c}" for c in NUMBERED_COLUMNS)} FROM numbered""",
        "cell_table": f"""{REPORT}, {_cells(REPORT_COLUMNS, lambda c: c, "report", WRAPPED)}
            SELECT "row", col, heading, text,
                   CASE WHEN is_total THEN '#0074bc'
                        WHEN text LIKE '%\\%%' ESCAPE '\\' THEN {_band(CELL_NUMBER)}
                        WHEN "row" % 2 = 0 THEN '#ffffff' ELSE '#eaf6ea' END AS background,
                   CASE WHEN is_total THEN 'bold' ELSE 'normal' END AS weight FROM cell""",
        "cell_table_numbered": f"""{NUMBERED_REPORT}, {_cells(NUMBERED_COLUMNS, _shown, "numbered", ONE_LINE)}
            SELECT "row", col, heading, text,
                   CASE WHEN name LIKE 'rate%' AND text <> '-' AND TRY_CAST(replace(text, '%', '') AS DOUBLE) > 50
                        THEN '#90EE90'
                        WHEN is_total THEN '#0072BC'
                        WHEN "row" % 2 = 0 THEN 'white' ELSE '#E8F4E8' END AS background,
                   CASE WHEN is_total THEN 'bold' ELSE 'normal' END AS weight FROM cell""",
        "dept_decode": f"""WITH {PARTNERS} SELECT code,
            CASE WHEN dept IN ({NAMES}) THEN 'N' || lpad(substr(dept, 8), 2, '0') END AS short_code,
            CASE WHEN dept IN ({NAMES}) THEN CAST(substr(dept, 8) AS BIGINT) END AS ordinal,
            dept IN ({NAMES}) AS listed FROM partner""",
        "year_in_text": f"""WITH {ORDERS} SELECT status, count(*) AS orders FROM purchase
            WHERE date_text LIKE '%{CURRENT_YEAR}%' GROUP BY status""",
        "year_typed": f"""SELECT o_orderstatus AS status, count(*) AS orders FROM orders
            WHERE year(o_orderdate) = {CURRENT_YEAR} GROUP BY o_orderstatus""",
        "collated_group": """SELECT min(segment) AS segment, count(*) AS n FROM (
              SELECT CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment FROM customer)
            GROUP BY lower(segment)""",
        "percent_parse_band": f"""WITH shown AS (
              SELECT CASE WHEN l_returnflag <> 'N' THEN CAST(replace(replace({PERCENT_TEXT}, '%', ''), ',', '.') AS DOUBLE) END AS number
              FROM lineitem)
            SELECT CASE WHEN number IS NULL THEN NULL WHEN number >= 80 THEN 5 WHEN number >= 60 THEN 4
                        WHEN number >= 40 THEN 3 WHEN number >= 20 THEN 2 ELSE 1 END AS band,
                   count(*) AS n, min(number) AS lowest, max(number) AS highest FROM shown GROUP BY 1""",
        "rate_over_50": """SELECT l_linestatus, l_returnflag <> 'N' AND CAST(l_quantity AS INTEGER) * 2 > 50 AS over,
            count(*) AS n FROM lineitem GROUP BY 1, 2""",
        "number_tidy": f"""SELECT {_tidy("l_quantity")} AS quantity, {_tidy("l_discount")} AS discount,
            {_tidy("(l_linenumber - 1)")} AS line, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""",
        "tolerant_number": f"""SELECT p_type, CAST(sum({_nums()}) AS BIGINT) AS total,
            CAST(sum(CASE WHEN {_nums()} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zeros FROM part GROUP BY p_type""",
        "blank_nan_clean": """WITH raw_rows AS (
              SELECT CASE c_custkey % 4 WHEN 1 THEN 'nan' WHEN 2 THEN '' WHEN 3 THEN c_mktsegment ELSE '' END AS raw,
                     c_custkey % 4 = 0 OR c_acctbal IS NULL AS blank FROM customer)
            SELECT raw, nullif(raw, 'nan') AS stored, count(*) AS n,
                   CAST(sum(CASE WHEN blank THEN 1 ELSE 0 END) AS BIGINT) AS blank_balances
            FROM raw_rows GROUP BY 1, 2""",
        "clean_headers": rf"""WITH named AS (
              SELECT doc_id AS id, 'documents' AS source, text FROM documents
              UNION ALL SELECT page_id, 'pages', url FROM pages),
            folded AS (SELECT id, source, {FOLDED} AS name FROM named),
            plain AS (SELECT *, regexp_replace(name, '[^\p{{L}}\p{{N}}_]', '', 'g') AS bare FROM folded)
            SELECT id, source, md5(regexp_replace(name, '[^a-z0-9_]', '', 'g')) AS ascii_name,
                   md5(regexp_replace(name, '[^\p{{L}}\p{{N}}_\s\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]', '', 'g')) AS unicode_name,
                   md5(CASE WHEN bare = '' THEN 'col_1' WHEN regexp_matches(bare, '^\p{{Nd}}') THEN 'col_' || bare ELSE bare END) AS table_column
            FROM plain""",
        "drop_first_column": """SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS "TEN_NGAN", s_name AS "TEN", n_name AS "MA_DV"
            FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
        "aliased_projection": """SELECT l_returnflag AS "PBH", l_orderkey AS thucuoc, l_partkey AS cskh_ob, l_suppkey AS ob_nc,
            CAST(l_linenumber AS BIGINT) AS "sla > 72", l_quantity AS baohong, l_extendedprice AS tuvan,
            l_discount AS td_tocdo, l_tax AS tong_ton FROM lineitem""",
        "concat_by_name": """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
            UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""",
        "head10": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
            ORDER BY o_totalprice, o_orderkey LIMIT 10""",
        "row_count": "SELECT count(*) AS total_rows FROM lineitem",
        "null_profile": """WITH gaps AS (
              SELECT count(*) FILTER (WHERE l_returnflag = 'N' OR l_discount IS NULL) AS l_discount,
                     count(*) FILTER (WHERE l_linenumber <= 2 OR l_shipdate IS NULL) AS l_shipdate,
                     count(*) FILTER (WHERE l_linestatus = 'O' OR l_linestatus IS NULL) AS l_linestatus,
                     count(*) FILTER (WHERE l_orderkey IS NULL) AS l_orderkey FROM lineitem)
            SELECT * FROM (
              SELECT 'l_discount' AS column_name, l_discount AS null_count FROM gaps
              UNION ALL SELECT 'l_shipdate', l_shipdate FROM gaps
              UNION ALL SELECT 'l_linestatus', l_linestatus FROM gaps
              UNION ALL SELECT 'l_orderkey', l_orderkey FROM gaps) WHERE null_count > 0""",
        "cross_catalog_count": """SELECT column_name, count(*) AS row_count FROM orders
            CROSS JOIN (VALUES ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'), ('o_orderpriority')) AS c(column_name)
            GROUP BY column_name HAVING count(*) > 0""",
        "table_profile": " UNION ALL ".join(_profile_part(t, c) for t, c in PROFILED.items()),
        "metadata_profile": " UNION ALL ".join(
            f"""SELECT '{t}' AS table_name, {i} AS position, '{c}' AS column_name, '{k}' AS data_type, count(*) AS total_rows,
                count(*) - count({c}) AS null_count, CAST({f"min({c})" if k in NUMBERS else "NULL"} AS DOUBLE) AS lowest,
                CAST({f"max({c})" if k in NUMBERS else "NULL"} AS DOUBLE) AS highest FROM {t}"""
            for t, columns in PROFILED.items()
            for i, (c, k) in enumerate(columns, start=1)
        ),
        "typed_load_append": """SELECT c_mktsegment, 2 * count(*) AS n, count(DISTINCT c_custkey) AS customers,
            min(c_acctbal) AS lowest, max(c_acctbal) AS highest FROM customer GROUP BY c_mktsegment""",
        "catalog_columns": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, {i} AS position, '{c}' AS column_name, '{k}' AS data_type, "
            f"CAST({255 if k.startswith('varchar') else 'NULL'} AS INTEGER) AS max_length, (SELECT count(*) FROM {t}) AS rows"
            for t in ("customer", "orders")
            for i, (c, k) in enumerate([("id", "bigint")] + [(c, LOADED.get(k, k)) for c, k in PROFILED[t]], start=1)
        ),
        "surrogate_id": """SELECT 'customer' AS feed, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id, count(*) AS n, count(*) AS ids FROM customer
            UNION ALL SELECT 'orders', (SELECT count(*) FROM customer) + 1,
                   (SELECT count(*) FROM customer) + count(*), count(*), count(*) FROM orders""",
        "load_rollback": """SELECT 'customer' AS feed, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id, count(*) AS ids, count(*) AS n,
                   max(length(c_name)) AS longest, true AS failed FROM customer
            UNION ALL SELECT 'orders', (SELECT count(*) FROM customer) + 1, (SELECT count(*) FROM customer) + count(*), count(*), count(*),
                   max(length(o_orderstatus)), true FROM orders""",
        "drop_tables": """SELECT 'customers' AS table_name, true AS dropped, (SELECT count(*) FROM customer) AS rows
            UNION ALL SELECT 'never_loaded', false, 0
            UNION ALL SELECT 'suppliers', true, (SELECT count(*) FROM supplier)""",
        "query_then_drop": f"""WITH {PARTNERS}, {ORDERS}
            SELECT p.dept, count(*) AS orders, count(DISTINCT p.code) AS partners
            FROM partner p JOIN purchase o ON o.code = p.code WHERE o.status = 'F' GROUP BY p.dept""",
        "incremental_ingest": """SELECT o_orderstatus, 2 * count(*) AS n, 2 * count(*) AS ids,
            -max(o_orderkey) AS lowest, max(o_orderkey) AS highest,
            (SELECT 2 * count(*) FROM orders) AS added FROM orders GROUP BY o_orderstatus""",
        "slice_plan": "SELECT CAST(16 AS BIGINT) AS slices, count(*) AS n, count(*) AS sliced, true AS even FROM lineitem",
        "merged_feeds": """WITH shaped AS (SELECT *, o_orderkey % 3 AS part, CAST(o_orderkey AS VARCHAR) AS name FROM orders)
            SELECT CASE WHEN part = 2 THEN 'K' || name ELSE name END AS o_orderkey,
                   CASE part WHEN 0 THEN o_totalprice WHEN 1 THEN floor(o_totalprice) END AS o_totalprice,
                   CASE part WHEN 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d 00:00:00')
                             WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS o_orderdate,
                   CASE part WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 2 THEN CAST(o_totalprice AS VARCHAR) END AS o_custkey,
                   CASE WHEN part = 1 THEN o_orderpriority END AS o_orderpriority,
                   CASE WHEN part = 2 THEN o_orderstatus END AS o_orderstatus
            FROM shaped""",
        "ingest_distinct": """WITH landed AS (
              SELECT DISTINCT o_orderkey, o_orderstatus, o_totalprice FROM orders)
            SELECT o_orderstatus, 2 * count(*) AS n, 2 * count(*) AS ids, -1 - max(o_orderkey) AS lowest, max(o_orderkey) AS highest,
                   (SELECT count(*) FROM landed) AS added_1, CAST(0 AS BIGINT) AS added_2, (SELECT count(*) FROM landed) AS added_3
            FROM landed GROUP BY o_orderstatus""",
        "drop_if_present": "SELECT r_regionkey FROM region",
        "short_backlog": """SELECT l_returnflag AS "PBH", l_orderkey AS thucuoc, l_partkey AS cskh_ob, l_suppkey AS cskh_ob_nc,
            CAST(l_linenumber AS BIGINT) AS cskh_sla_lonhon_72, l_quantity AS baohong, l_extendedprice AS tuvan,
            l_tax AS tong_ton FROM lineitem""",
        "select_all": "SELECT * FROM supplier",
        "table_names": """SELECT url || '/Báo cáo ' || page_id || '.v2.XLSX' AS file,
            'báocáo' || page_id || 'v2' AS table_name FROM pages""",
        "blank_headers": """WITH header AS (
              SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE l_returnflag || l_linestatus END AS name,
                     row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE l_returnflag || l_linestatus END) AS place
              FROM lineitem),
            counted AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, name ORDER BY place) - 1 AS before FROM header)
            SELECT l_orderkey, string_agg(CASE WHEN name = '' THEN 'col_' || place WHEN before > 0 THEN name || '.' || before
                                               ELSE name END, '|' ORDER BY place) AS names
            FROM counted GROUP BY l_orderkey""",
        "total_last": """SELECT dept, count(*) AS n, coalesce(dept = 'TOTAL', false) AS is_total FROM (
              SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'TOTAL' ELSE c_mktsegment END AS dept
              FROM customer) GROUP BY dept""",
    }
    return {name: textwrap.dedent(text).strip() for name, text in statements.items()}
