"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partnerscope.functions import naming, rates, values
from partnerscope.operators import cells, digest, incremental, layout, measures, profile, report, tables
from partnerscope.params import ORDER_TABLE, PARTNER_TABLE
from partnerscope.plans import jobs
from partnerscope.plans.star_model import (
    star_orders,
    star_params,
    star_partners,
    star_partners_extended,
    table,
    with_blank_codes,
    with_mixed_codes,
    with_mixed_case,
)
from partnerscope.session import kept, passing_database, passing_folder
from partnerscope.sources import feeds, jdbc
from partnerscope.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _model(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return star_partners(spark, folder), star_orders(spark, folder)


def _report(spark: SparkSession, folder: str) -> DataFrame:
    return report.partner_report(*_model(spark, folder), star_params())


def _numbered(spark: SparkSession, folder: str) -> DataFrame:
    return report.numbered_report(_report(spark, folder))


def _published(rows: DataFrame) -> DataFrame:
    return report.in_report_order(rows).select(*report.REPORT_COLUMNS)


# ------------------------------------------------------------------ the report


@query
def partner_report(spark, folder):
    return _published(_report(spark, folder))


@query
def partner_report_rollup(spark, folder):
    return _published(report.partner_report_rollup(*_model(spark, folder), star_params()))


@query
def partner_report_two_level(spark, folder):
    return _published(report.partner_report_two_level(*_model(spark, folder), star_params()))


@query
def partner_report_typed(spark, folder):
    """Year test as a date range, which reaches the scan."""
    return _published(report.partner_report(*_model(spark, folder), star_params(typed_dates=True)))


@query
def partner_report_shared_codes(spark, folder):
    """Codes in several departments and a partner without code: the total is not a sum."""
    partners = star_partners_extended(spark, folder)
    return _published(report.partner_report(partners, star_orders(spark, folder), star_params()))


@query
def partner_report_blank_codes(spark, folder):
    """Empty codes are one code like any other, on both sides."""
    partners, orders = (with_blank_codes(df) for df in _model(spark, folder))
    return _published(report.partner_report(partners, orders, star_params()))


@query
def partner_report_blank_as_null(spark, folder):
    """Empty codes count as missing: neither counted nor joined."""
    partners, orders = (with_blank_codes(df) for df in _model(spark, folder))
    return _published(report.partner_report(partners, orders, star_params(blank_as_null=True)))


@query
def partner_report_collated(spark, folder):
    """Status texts that differ in case only are the same under a collation."""
    partners, orders = (with_mixed_case(df) for df in _model(spark, folder))
    return _published(report.partner_report(partners, orders, star_params(collation="UTF8_LCASE")))


@query
def report_incremental(spark, folder):
    """The report after three batches with repeated rows, the last one taken twice, from merged state."""
    partners, orders = _model(spark, folder)
    with passing_folder(spark, "state") as place:
        state = incremental.ReportState(spark, place, star_params())
        for batch in range(3):
            own = f"pmod(code, 3) = {batch} OR pmod(code, 7) = 0"
            late = f"pmod(ord_id, 3) = {batch} OR pmod(ord_id, 5) = 0"
            state.add(f"b{batch}", partners.where(own), orders.where(late))
        state.add("b2", orders=orders.where(late))
        state.compact("merged")
        return kept(_published(state.report()))


@query
def bucketed_report(spark, folder):
    """The report of tables bucketed by code, with codes in two departments: no order leaves its bucket."""
    with passing_database(spark, "bucketed") as database:
        laid_out = layout.ReportTables(spark, database, int(spark.conf.get("spark.sql.shuffle.partitions")))
        laid_out.load(star_partners_extended(spark, folder), star_orders(spark, folder))
        return kept(_published(laid_out.report(star_params())))


@query
def partner_report_pruned(spark, folder):
    """The report of orders that lie in folders by year: other years' folders aren't opened."""
    params = star_params()
    with passing_database(spark, "pruned") as database:
        layout.save_by_year(star_orders(spark, folder), f"`{database}`.orders")
        orders = layout.of_year(spark.table(f"`{database}`.orders"), params)
        return kept(_published(report.partner_report(star_partners(spark, folder), orders, params)))


@query
def partner_report_numbered(spark, folder):
    return report.in_number_order(_numbered(spark, folder)).select(*report.NUMBERED_COLUMNS)


@query
def partner_total_only(spark, folder):
    rows = report.total_row(*_model(spark, folder), star_params())
    return rows.select(*report.REPORT_COLUMNS)


@query
def report_headings(spark, folder):
    return naming.with_headings(_published(_report(spark, folder)), star_params())


@query
def report_wrapped_headings(spark, folder):
    return naming.with_wrapped_headings(_published(_report(spark, folder)), star_params())


@query
def report_one_line_headings(spark, folder):
    numbered = _numbered(spark, folder).select(*report.NUMBERED_COLUMNS)
    return naming.with_one_line_headings(numbered, star_params())


@query
def report_upper_headers(spark, folder):
    return naming.upper_headers(_published(_report(spark, folder)))


@query
def new_partners_by_dept(spark, folder):
    rows = report.new_partners(star_partners(spark, folder), star_params())
    return rows.select("dept", "new_current", "new_prior", "existing")


@query
def active_partners_by_dept(spark, folder):
    rows = report.active_partners(*_model(spark, folder), star_params())
    return rows.select("dept", "active_current", "active_prior", "active_total")


@query
def conversion_rates(spark, folder):
    rows = report.active_partners(*_model(spark, folder), star_params())
    return rows.select("dept", "rate_current", "rate_prior", "rate_overall")


@query
def order_success_rate(spark, folder):
    rows = report.order_success(*_model(spark, folder), star_params())
    return rows.select("dept", "orders_raised", "orders_ok", "order_rate")


@query
def partner_activity(spark, folder):
    return report.partner_activity(*_model(spark, folder), star_params())


@query
def partner_orders_fanout(spark, folder):
    return report.join_sizes(*_model(spark, folder), star_params())


@query
def nulls_last_order(spark, folder):
    """Place of each row when the row without number goes last."""
    numbered = report.in_number_order(_numbered(spark, folder)).select("stt", "dept", "existing")
    place = F.coalesce(F.col("stt"), F.lit(999999).cast("bigint"))
    return numbered.withColumn("sort_key", place)


@query
def union_total_last(spark, folder):
    """Two halves put together by position: departments, then the total.

    Both come from the same rows; the engine computes what they share once.
    """
    rows = report.new_partners(star_partners(spark, folder), star_params())
    main = rows.where(~F.col("is_total")).select(F.col("ord").cast("bigint"), "dept", "new_current")
    total = rows.where("is_total").select(F.lit(None), F.lit(star_params().total_label), "new_current")
    return main.union(total).orderBy(F.col("ord").asc_nulls_last())


# ------------------------------------------------------------ digest and cells


@query
def top3_by_count(spark, folder):
    return digest.top_by_count(_report(spark, folder))


@query
def top3_by_rate(spark, folder):
    return digest.top_by_rate(_report(spark, folder))


@query
def bottom3_by_rate(spark, folder):
    return digest.bottom_by_rate(_report(spark, folder))


@query
def digest_parts(spark, folder):
    return digest.digest_parts(_report(spark, folder))


@query
def digest_message(spark, folder):
    return digest.digest_message(_report(spark, folder), star_params())


@query
def zero_dash_display(spark, folder):
    shown = cells.display_report(_numbered(spark, folder), star_params())
    return shown.select(*report.NUMBERED_COLUMNS)


@query
def cell_table(spark, folder):
    return cells.banded_cells(_report(spark, folder), star_params())


@query
def cell_table_numbered(spark, folder):
    return cells.numbered_cells(_numbered(spark, folder), star_params())


# -------------------------------------------------- predicates and expressions


@query
def dept_decode(spark, folder):
    """Code and ordinal of every partner's department, NULL for one that is not listed."""
    params = star_params()
    return star_partners(spark, folder).select(
        "code",
        measures.department_code("dept", params).alias("short_code"),
        measures.department_ordinal("dept", params).cast("bigint").alias("ordinal"),
        measures.in_departments("dept", params).alias("listed"),
    )


@query
def year_in_text(spark, folder):
    orders = star_orders(spark, folder)
    found = orders.where(measures.year_in_text("date_text", star_params().current_year))
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("orders"))


@query
def year_typed(spark, folder):
    orders = star_orders(spark, folder)
    found = orders.where(measures.year_of_date("order_date", star_params().current_year))
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("orders"))


@query
def partner_report_text_codes(spark, folder):
    """Codes as texts in changing case, the same under a collation, on both sides."""
    partners, orders = (with_mixed_codes(df) for df in _model(spark, folder))
    return _published(report.partner_report(partners, orders, star_params(collation="UTF8_LCASE")))


@query
def total_last(spark, folder):
    """Customers by segment, some without a label, the row labelled as total last."""
    segment = F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).when(F.col("c_mktsegment") == "MACHINERY", F.lit("TOTAL")).otherwise(F.col("c_mktsegment"))
    counts = table(spark, folder, "customer").select(segment.alias("dept")).groupBy("dept").agg(F.count(F.lit(1)).alias("n"))
    return cells.total_last(counts, "dept", "TOTAL")


@query
def collated_group(spark, folder):
    """Texts that differ in case only are one group, under the first of its spellings."""
    text = F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    spelled = table(spark, folder, "customer").select(text.alias("segment"))
    return measures.collated_counts(spelled, "segment", "UTF8_LCASE")


def _percent_text() -> Column:
    """Percents from 2,1% up, every other one with a point."""
    whole = (F.col("l_quantity").cast("int") * 2).cast("string")
    mark = F.when(F.col("l_orderkey") % 2 == 0, F.lit(".")).otherwise(F.lit(","))
    return F.concat(whole, mark, F.col("l_linenumber").cast("string"), F.lit("%"))


@query
def percent_parse_band(spark, folder):
    lines = table(spark, folder, "lineitem")
    text = F.when(F.col("l_returnflag") == "N", F.lit("-")).otherwise(_percent_text())
    numbers = lines.select(text.alias("text")).select(rates.percent_number(F.col("text")).alias("number"))
    shown = numbers.withColumn("band", rates.number_band(F.col("number")))
    return shown.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.min("number").alias("lowest"), F.max("number").alias("highest")
    )


@query
def rate_over_50(spark, folder):
    lines = table(spark, folder, "lineitem")
    whole = (F.col("l_quantity").cast("int") * 2).cast("string")
    text = F.when(F.col("l_returnflag") == "N", F.lit("-")).otherwise(F.concat(whole, F.lit("%")))
    shown = lines.select("l_linestatus", rates.rate_above(text).alias("over"))
    return shown.groupBy("l_linestatus", "over").agg(F.count(F.lit(1)).alias("n"))


@query
def number_tidy(spark, folder):
    lines = table(spark, folder, "lineitem")
    tidy = lines.select(
        values.number_tidy(F.col("l_quantity")).alias("quantity"),
        values.number_tidy(F.col("l_discount")).alias("discount"),
        values.number_tidy(F.col("l_linenumber") - 1).alias("line"),
    )
    return tidy.groupBy("quantity", "discount", "line").agg(F.count(F.lit(1)).alias("n"))


@query
def tolerant_number(spark, folder):
    """Whole numbers out of texts; texts without a number, or with one too large, count as 0."""
    parts = table(spark, folder, "part")
    brand = F.regexp_replace("p_brand", "^Brand#", "")
    number = F.when(F.col("p_size") % 3 == 1, F.concat(brand, F.lit("e30"))).otherwise(F.concat(brand, F.lit(".75")))
    texts = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(number)
    return parts.groupBy("p_type").agg(
        F.sum(values.tolerant_int(texts)).alias("total"), F.count_if(values.tolerant_int(texts) == 0).alias("zeros")
    )


@query
def text_total(spark, folder):
    """Sum of whole numbers held as text, empty where there is none."""
    lines = table(spark, folder, "lineitem")
    text = F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    return digest.text_total(lines.select(text.alias("quantity")), "quantity")


@query
def blank_nan_clean(spark, folder):
    """Blanks filled on reading; on loading only missing values and ``nan`` become NULL."""
    key = F.col("c_custkey") % 4
    raw = table(spark, folder, "customer").select(
        F.when(key == 1, F.lit("nan")).when(key == 2, F.lit("")).when(key == 3, F.col("c_mktsegment")).alias("raw"),
        F.when(key != 0, F.col("c_acctbal")).alias("balance"),
    )
    loaded = values.blank_fill(raw).withColumn("stored", values.null_for_load(F.col("raw")))
    return loaded.groupBy("raw", "stored").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("balance") == "").alias("blank_balances")
    )


@query
def clean_headers(spark, folder):
    """The name rules on whole texts; hashes stand for the long results."""
    texts = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.lit("documents").alias("source"), "text")
    urls = table(spark, folder, "pages").select("page_id", F.lit("pages"), "url")
    names = texts.union(urls)
    return names.select(
        "id",
        "source",
        F.md5(naming.ascii_name_column(F.col("text"))).alias("ascii_name"),
        F.md5(naming.unicode_name_column(F.col("text"))).alias("unicode_name"),
        F.md5(naming.table_column_column(F.col("text"), F.lit(1))).alias("table_column"),
    )


# --------------------------------------------------------- projection, sets, profile


@query
def drop_first_column(spark, folder):
    """The branch list of four columns, shown without the first."""
    supplier, nation = table(spark, folder, "supplier"), table(spark, folder, "nation")
    branches = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("DONVI_ID"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("TEN_NGAN"),
        F.col("s_name").alias("TEN"),
        F.col("n_name").alias("MA_DV"),
        F.col("s_acctbal").alias("unused"),
    )
    return cells.drop_first_column(jdbc.branch_list(branches))


@query
def drop_if_present(spark, folder):
    """One column that is there and one that isn't, left out."""
    return cells.drop_if_present(cells.drop_if_present(table(spark, folder, "region"), "r_name"), "no_such_column")


def _backlogs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("PBH"),
        F.col("l_orderkey").alias("thucuoc"),
        F.col("l_partkey").alias("cskh_ob"),
        F.col("l_suppkey").alias("cskh_ob_nc"),
        F.col("l_linenumber").cast("bigint").alias("cskh_sla_lonhon_72"),
        F.col("l_quantity").alias("baohong"),
        F.col("l_extendedprice").alias("tuvan"),
        F.col("l_discount").alias("td_tocdo"),
        F.col("l_tax").alias("tong_ton"),
        F.col("l_shipdate"),
    )


@query
def aliased_projection(spark, folder):
    """The backlog report: columns picked, two renamed, one name with symbols."""
    return jdbc.backlog(_backlogs(spark, folder))


@query
def short_backlog(spark, folder):
    """The short form of the backlog report: columns picked, none renamed."""
    return jdbc.backlog(_backlogs(spark, folder), short=True)


@query
def select_all(spark, folder):
    """A whole table by a query's text."""
    table(spark, folder, "supplier").createOrReplaceTempView("select_all_supplier")
    return jobs.run_query(spark, default="SELECT * FROM select_all_supplier")


@query
def table_names(spark, folder):
    """Table names from file names with folder and ending."""
    files = table(spark, folder, "pages").select(F.concat("url", F.lit("/Báo cáo "), F.col("page_id").cast("string"), F.lit(".v2.XLSX")).alias("file"))
    return files.select("file", naming.table_name_column(F.col("file")).alias("table_name"))


@query
def blank_headers(spark, folder):
    """Header rows with blank and repeated headers: one per order, of its lines."""
    header = F.when(F.col("l_linenumber") % 3 == 0, F.lit("")).otherwise(F.concat("l_returnflag", "l_linestatus"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.struct("l_linenumber", header.alias("header")).alias("cell"))
    rows = lines.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list("cell")), lambda c: c["header"]).alias("headers"))
    return rows.select("l_orderkey", F.array_join(naming.fill_blank_headers_column(F.col("headers")), "|").alias("names"))


@query
def concat_by_name(spark, folder):
    """Customers and suppliers as one frame; columns go by name, a missing one is NULL."""
    customers = table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, folder, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query
def merged_feeds(spark, folder):
    """Three shapes of the orders table: other types, another order of columns, columns missing."""
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    key, part = F.col("o_orderkey"), F.pmod(F.col("o_orderkey"), F.lit(3))
    shapes = [
        orders.where(part == 0).select(key.cast("int").alias("o_orderkey"), "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_custkey"),
        orders.where(part == 1).select("o_orderpriority", F.floor("o_totalprice").alias("O_TOTALPRICE"), "o_orderkey", "o_orderdate"),
        orders.where(part == 2).select("o_orderstatus", F.concat(F.lit("K"), key.cast("string")).alias("o_orderkey"), F.col("o_totalprice").cast("string").alias("o_custkey")),
    ]
    with passing_folder(spark, "shapes") as place:
        paths = [f"{place}/{number}" for number in range(len(shapes))]
        for path, shape in zip(paths, shapes, strict=True):
            shape.write.parquet(path)
        return kept(feeds.read_merged(spark, paths).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))


@query
def slice_plan(spark, folder):
    """Lines in 16 slices by a key that a third of them share: slices of one size, each line in one."""
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_partkey"))
    lines = table(spark, folder, "lineitem").select(hot.cast("bigint").alias("part"), "l_orderkey")
    conditions = jdbc.slice_conditions(jdbc.slice_cuts(lines, "part", "l_orderkey", 16), "part", "l_orderkey")
    sizes = lines.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.expr(c)).alias(f"s{i}") for i, c in enumerate(conditions)])
    every = F.array(*[f"s{i}" for i in range(len(conditions))])
    return sizes.select(
        F.size(every).cast("bigint").alias("slices"),
        "n",
        F.aggregate(every, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("sliced"),
        (F.array_max(every) <= F.array_min(every) * 1.1).alias("even"),
    )


@query
def head10(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return profile.head(orders, "o_totalprice", "o_orderkey")


@query
def row_count(spark, folder):
    return profile.row_count(table(spark, folder, "lineitem"))


@query
def null_profile(spark, folder):
    """Missing values per column of lines with gaps."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_linenumber") > 2, F.col("l_shipdate")).alias("l_shipdate"),
        F.nullif("l_linestatus", F.lit("O")).alias("l_linestatus"),
    )
    return profile.null_profile(lines)


@query
def cross_catalog_count(spark, folder):
    """Rows counted per column name, as if the table were crossed with its column list."""
    return profile.rows_per_column(table(spark, folder, "orders"), skip=("o_orderkey",))


@query
def table_profile(spark, folder):
    """Column list, row count, missing values and longest text of several tables."""
    names = ("customer", "orders", "lineitem", "documents")
    profiles = [profile.table_profile(table(spark, folder, n), n) for n in names]
    whole = profiles[0]
    for part in profiles[1:]:
        whole = whole.unionByName(part)
    return whole


@query
def metadata_profile(spark, folder):
    """Rows, missing values and bounds of the columns of several tables, from the files' footers."""
    names = ("customer", "orders", "lineitem", "documents")
    profiles = [profile.metadata_profile(spark, f"{folder}/{n}.parquet", n) for n in names]
    return reduce(DataFrame.unionAll, profiles).drop("first_date", "last_date")


# ------------------------------------------------------- loading and whole jobs


def _partner_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Partners under the positional names of the feed."""
    return star_partners(spark, folder).select(
        F.col("code").alias("col_3"),
        F.col("dept").alias("col_14"),
        F.col("reg_text").alias("col_17"),
        F.col("status").alias("col_22"),
    )


def _order_feed(spark: SparkSession, folder: str) -> DataFrame:
    return star_orders(spark, folder).select(
        F.col("ord_id").alias("col_3"),
        F.col("code").alias("col_12"),
        F.col("date_text").alias("col_25"),
        F.col("status").alias("col_27"),
    )


def _load(spark: SparkSession, frame: DataFrame, database: str, name: str) -> int:
    layout = feeds.frame_layout(frame, wide=True)
    return tables.load_frame(spark, feeds.frame_to_load(frame, layout), layout, database, name)


def _load_files(spark: SparkSession, files: DataFrame, database: str, name: str) -> int:
    return tables.load_files(spark, files, feeds.frame_layout(files, wide=True), database, name)


@query
def typed_load_append(spark, folder):
    """A feed loaded twice into one typed table: the second load is appended."""
    customers = table(spark, folder, "customer")
    with passing_database(spark, "typed_load") as database:
        for _ in range(2):
            _load_files(spark, customers, database, "customers")
        loaded = spark.table(f"{database}.customers").groupBy("c_mktsegment")
        return kept(
            loaded.agg(
                F.count(F.lit(1)).alias("n"),
                F.count_distinct("c_custkey").alias("customers"),
                F.min("c_acctbal").alias("lowest"),
                F.max("c_acctbal").alias("highest"),
            )
        )


@query
def catalog_columns(spark, folder):
    """Columns of two loaded tables as the catalog lists them, with the rows loaded."""
    loaded = None
    with passing_database(spark, "catalog") as database:
        for name in ("customer", "orders"):
            rows = _load_files(spark, table(spark, folder, name), database, name)
            listed = profile.table_columns(spark, name, database).withColumn("rows", F.lit(rows).cast("bigint"))
            loaded = listed if loaded is None else loaded.unionByName(listed)
    return loaded.drop("table_schema")


@query
def surrogate_id(spark, folder):
    """Ids of a first load and of one appended after it: no gap, no repeat."""
    customers = table(spark, folder, "customer").select(F.lit("customer").alias("feed"), F.col("c_custkey").alias("key"))
    orders = table(spark, folder, "orders").select(F.lit("orders").alias("feed"), F.col("o_orderkey").alias("key"))
    with passing_database(spark, "ids") as database:
        for frame in (customers, orders):
            _load(spark, frame, database, "loaded")
        loaded = spark.table(f"{database}.loaded").groupBy("feed")
        return kept(
            loaded.agg(
                F.min("id").alias("first_id"),
                F.max("id").alias("last_id"),
                F.count("id").alias("n"),
                F.count_distinct("id").alias("ids"),
            )
        )


@query
def load_rollback(spark, folder):
    """Customers loaded, a second load that fails at an overlong text, orders loaded after it.

    The failed load leaves nothing, and ids go on without a gap.
    """
    customers = table(spark, folder, "customer").select(F.lit("customer").alias("feed"), F.col("c_custkey").alias("key"), F.col("c_name").alias("label"))
    orders = table(spark, folder, "orders").select(F.lit("orders").alias("feed"), F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("label"))
    spoilt = customers.withColumn("label", F.expr("CASE WHEN key % 100 = 7 THEN repeat(label, 300) ELSE label END"))
    with passing_database(spark, "rollback") as database:
        _load(spark, customers, database, "loaded")
        try:
            _load(spark, spoilt, database, "loaded")
        except PySparkException:
            failed = True
        else:
            failed = False
        _load(spark, orders, database, "loaded")
        loaded = spark.table(f"{database}.loaded").groupBy("feed")
        ids = [F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count_distinct("id").alias("ids")]
        return kept(loaded.agg(*ids, F.count(F.lit(1)).alias("n"), F.max(F.length("label")).cast("bigint").alias("longest"), F.lit(failed).alias("failed")))


@query
def drop_tables(spark, folder):
    """Two loaded tables and one that never was, dropped in one call."""
    with passing_database(spark, "dropped") as database:
        loaded = {
            "customers": _load_files(spark, table(spark, folder, "customer"), database, "customers"),
            "suppliers": _load_files(spark, table(spark, folder, "supplier"), database, "suppliers"),
        }
        results = tables.drop_tables(spark, database, ["customers", "never_loaded", "suppliers"])
    rows = [(name, gone, loaded.get(name, 0)) for name, gone, _ in results]
    return spark.createDataFrame(rows, "table_name string, dropped boolean, rows bigint")


@query
def query_then_drop(spark, folder):
    """A query with a parameter over two loaded tables, its result kept, the tables dropped."""
    with passing_database(spark, "query_then_drop") as database:
        _load(spark, _partner_feed(spark, folder), database, PARTNER_TABLE)
        _load(spark, _order_feed(spark, folder), database, ORDER_TABLE)
        text = f"""
            SELECT p.col_14 AS dept, count(*) AS orders, count(DISTINCT p.col_3) AS partners
            FROM `{database}`.`{PARTNER_TABLE}` p JOIN `{database}`.`{ORDER_TABLE}` o ON o.col_12 = p.col_3
            WHERE o.col_27 = :status GROUP BY p.col_14
        """
        return jobs.query_then_drop(spark, text, database, status=star_params().success)


@query
def loaded_report(spark, folder):
    """The report job: both feeds into typed tables, the report kept, the tables dropped."""
    with passing_database(spark, "loaded_report") as database:
        _load(spark, _partner_feed(spark, folder), database, PARTNER_TABLE)
        _load(spark, _order_feed(spark, folder), database, ORDER_TABLE)
        delivery = jobs.generate_report(spark, database, star_params())
        jobs.cleanup(spark, database)
    return delivery.report.select(*report.REPORT_COLUMNS)


@query
def incremental_ingest(spark, folder):
    """Two feeds of landed files into one table; taking each a second time adds nothing."""
    # Orders, and the same orders as another source has them: with keys of its own.
    schema = table(spark, folder, "orders").schema
    feeds_of = {"first": lambda rows: rows, "second": lambda rows: rows.withColumn("o_orderkey", -F.col("o_orderkey"))}
    with passing_folder(spark, "ingest") as place, passing_database(spark, "ingest") as database:
        ingest.create_target(spark, database, "orders", [("o_orderkey", "bigint"), ("o_orderstatus", "string")])
        added = 0
        for _ in range(2):
            for name, change in feeds_of.items():
                stream = ingest.landed_rows(spark, f"{folder}/orders.parque[t]", schema)

                def clean(rows, change=change):
                    return change(rows).select("o_orderkey", "o_orderstatus")

                added += ingest.ingest_new(stream, clean, database, "orders", f"{place}/{name}")
        rows = ingest.ingested(spark, database, "orders").groupBy("o_orderstatus")
        return kept(
            rows.agg(
                F.count(F.lit(1)).alias("n"),
                F.count_distinct("id").alias("ids"),
                F.min("o_orderkey").alias("lowest"),
                F.max("o_orderkey").alias("highest"),
                F.lit(added).cast("bigint").alias("added"),
            )
        )


@query
def ingest_distinct(spark, folder):
    """Orders that land three times under other names, the last time with as many new ones: each is added once."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    late = orders.union(orders.withColumn("o_orderkey", -1 - F.col("o_orderkey")))
    with passing_folder(spark, "distinct") as place, passing_database(spark, "distinct") as database:
        ingest.create_target(spark, database, "orders", [("o_orderkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double")])
        added = []
        for landing in (orders, orders, late):
            landing.write.mode("append").parquet(f"{place}/landing")
            stream = ingest.landed_rows(spark, f"{place}/landing", orders.schema)
            added.append(ingest.ingest_distinct(stream, lambda rows: rows, database, "orders", f"{place}/checkpoint"))
        rows = ingest.ingested(spark, database, "orders").groupBy("o_orderstatus")
        return kept(
            rows.agg(
                F.count(F.lit(1)).alias("n"),
                F.count_distinct("id").alias("ids"),
                F.min("o_orderkey").alias("lowest"),
                F.max("o_orderkey").alias("highest"),
                *[F.lit(n).cast("bigint").alias(f"added_{i}") for i, n in enumerate(added, start=1)],
            )
        )
