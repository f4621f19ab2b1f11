"""Tables laid out for the report, so that it moves no orders and reads those of its year only.

* Orders lie in folders of the year that their date text names, so a report opens the folders of
  its year and of the texts that name several.
* Partners and orders are bucketed by code. Grouping and join then work within a bucket, and what
  leaves it are a few rows of counts. A code with more rows than two average buckets is dealt over
  several slots by order id, with its partner rows in each of them; bucket key is code and slot.
* An order id that stands under several codes can't be counted within buckets. Such ids are found
  at load and their orders lie in folders of their own; only they are grouped by id across buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partnerscope.operators.measures import listed_partners, year_orders
from partnerscope.operators.report import _bit, _count_bits, _placed, _summed, finish
from partnerscope.params import ReportParams

#: Years with a folder of their own, and the folders of texts that name none or several of them.
FIRST_YEAR, LAST_YEAR = 1900, 2100
NO_YEAR, SEVERAL_YEARS = 0, -1

SLOT, SHARED, YEAR = "_slot", "_shared", "_year"
PARTNERS, ORDERS = "partners", "orders"


def year_folder(text: Column) -> Column:
    """The only year that the text names anywhere, also amid longer numbers; else one of two marks."""
    named = F.regexp_extract_all(text, F.lit(r"(?=(\d{4}))"), F.lit(1))
    years = F.array_distinct(F.filter(F.transform(named, lambda y: y.cast("int")), lambda y: y.between(FIRST_YEAR, LAST_YEAR)))
    one = F.when(F.size(years) == 1, years[0]).when(F.size(years) > 1, F.lit(SEVERAL_YEARS))
    return F.coalesce(one, F.lit(NO_YEAR)).cast("int")


def save_by_year(orders: DataFrame, table: str, text: str = "date_text") -> None:
    """Writes orders to folders by the year in their text, as many files as tasks and years."""
    orders.withColumn(YEAR, year_folder(F.col(text))).write.partitionBy(YEAR).saveAsTable(table)


def of_year(orders: DataFrame, params: ReportParams) -> DataFrame:
    """Orders in the folders that the report's year can be in; its own test still decides on each.

    A report by typed dates, or of a year without a folder, reads all.
    """
    if params.typed_dates or not FIRST_YEAR <= params.current_year <= LAST_YEAR:
        return orders
    return orders.where(F.col(YEAR).isin(params.current_year, SEVERAL_YEARS))


def hot_codes(orders: DataFrame, buckets: int) -> DataFrame:
    """``_hot, _slots``: codes with more rows than two average buckets; fewer than half as many as buckets."""
    counts = orders.where("code IS NOT NULL").groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    limit = 2 * (orders.count() // buckets + 1)
    found = counts.where(F.col("n") > limit).select("code", F.ceil(F.col("n") / limit).cast("int"))
    kind = orders.schema["code"].dataType.simpleString()
    return orders.sparkSession.createDataFrame([tuple(r) for r in found.collect()], f"_hot {kind}, _slots int")


def several_codes(orders: DataFrame) -> DataFrame:
    """``_id``: order ids that stand under more than one code."""
    ids = orders.where("ord_id IS NOT NULL AND code IS NOT NULL").groupBy("ord_id")
    return ids.agg((F.min("code") < F.max("code")).alias("_many")).where("_many").select(F.col("ord_id").alias("_id"))


@dataclass(frozen=True)
class ReportTables:
    """Partners and orders of one database, laid out for the report.

    ``load`` writes both anew from whole feeds; their codes must have one type. Other columns of
    the feeds stay. Copies of one order, same code and id, stay in one slot, as they count once.
    Keys meet as they stand: reports under a collation are refused.
    """

    spark: SparkSession
    database: str
    buckets: int

    def load(self, partners: DataFrame, orders: DataFrame) -> None:
        hot = F.broadcast(hot_codes(orders, self.buckets))
        many = several_codes(orders)
        # An order without id counts for nothing but activity: it may lie in any slot.
        dealt = F.when(F.col("ord_id").isNull(), F.xxhash64("date_text", "status")).otherwise(F.xxhash64("ord_id"))
        slotted = orders.join(hot, F.col("code") == F.col("_hot"), "left").select(
            "*", F.coalesce(1 + F.pmod(dealt, F.col("_slots")).cast("int"), F.lit(0)).alias(SLOT)
        )
        marked = slotted.join(many, F.col("ord_id") == F.col("_id"), "left").select(
            *[F.col(f"`{c}`") for c in orders.columns], SLOT,
            F.col("_id").isNotNull().alias(SHARED), year_folder(F.col("date_text")).alias(YEAR),
        )
        self._save(marked, ORDERS, [YEAR, SHARED])
        slots = F.when(F.col("_slots").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.col("_slots")))
        copied = partners.join(hot, F.col("code") == F.col("_hot"), "left").select(
            *[F.col(f"`{c}`") for c in partners.columns], F.explode(slots).alias(SLOT)
        )
        self._save(copied, PARTNERS, [])

    def _save(self, rows: DataFrame, name: str, folders: list[str]) -> None:
        # Dealt by the same hash as the buckets: a task writes one bucket, so each has one file in a folder.
        dealt = rows.repartition(self.buckets, "code", SLOT)
        writer = dealt.write.mode("overwrite").format("parquet").bucketBy(self.buckets, "code", SLOT)
        writer = writer.sortBy("code", SLOT)
        (writer.partitionBy(*folders) if folders else writer).saveAsTable(f"`{self.database}`.`{name}`")

    def _bits(self, params: ReportParams) -> DataFrame:
        """Department bits of each code and slot."""
        bit = _bit(params)
        within = {"listed": "true", "new_current": "is_current", "new_prior": "is_prior", "owner": "verified"}
        bits = [F.expr(f"bit_or(CASE WHEN {test} THEN {bit} ELSE 0L END) AS {name}") for name, test in within.items()]
        partners = self.spark.table(f"`{self.database}`.`{PARTNERS}`")
        return listed_partners(partners, params, keep=(SLOT,)).groupBy("code", SLOT).agg(*bits)

    def _orders(self, params: ReportParams) -> DataFrame:
        """Each order of the year once for each code: ``code, _slot, _shared, ord_id, ok``."""
        orders = of_year(self.spark.table(f"`{self.database}`.`{ORDERS}`"), params)
        facts = year_orders(orders, params, keep=(SLOT, SHARED))
        return facts.groupBy("code", SLOT, SHARED, "ord_id").agg(F.expr("bool_or(ok) AS ok"))

    def within_buckets(self, params: ReportParams) -> DataFrame:
        """A row of counts for each kind of bits: ``n`` codes, their orders raised and successful.

        Ids under several codes count for activity only. The slots of a hot code are one code.
        """
        own = f"ord_id IS NOT NULL AND NOT {SHARED}"
        per_code = self._orders(params).groupBy("code", SLOT).agg(
            F.expr("bool_or(ok) AS active"), F.expr(f"count_if({own}) AS raised"), F.expr(f"count_if(ok AND {own}) AS done")
        )
        rows = self._bits(params).join(per_code, ["code", SLOT], "left").withColumn("hot", F.expr(f"CASE WHEN {SLOT} > 0 THEN code END"))
        bits = ("hot", "listed", "new_current", "new_prior", "owner")
        sums = [F.sum(c).alias(c) for c in ("raised", "done")]
        kinds = rows.groupBy(*bits, F.expr("coalesce(active, false)").alias("active")).agg(F.count(F.lit(1)).alias("n"), *sums)
        of_hot = F.expr("CASE WHEN hot IS NULL THEN active END").alias("plain")
        merged = kinds.groupBy(*bits, of_hot).agg(F.expr("bool_or(active) AS active"), F.sum("n").alias("n"), *sums)
        return merged.withColumn("n", F.expr("CASE WHEN hot IS NULL THEN n ELSE 1L END"))

    def across_buckets(self, params: ReportParams) -> DataFrame:
        """Department bits of the ids that stand under several codes, one row for each id."""
        shared = self._orders(params).where(F.col(SHARED) & F.col("ord_id").isNotNull())
        owners = self._bits(params).where("owner <> 0").select("code", SLOT, "owner")
        return shared.join(owners, ["code", SLOT]).groupBy("ord_id").agg(
            F.expr("bit_or(owner) AS orders_raised"), F.expr("bit_or(CASE WHEN ok THEN owner ELSE 0L END) AS orders_ok")
        )

    def report(self, params: ReportParams) -> DataFrame:
        """The report, unordered; the same rows as ``partner_report`` has of the feeds."""
        if params.collation is not None:
            raise ValueError("tables are bucketed by code as it stands: no report under a collation")
        counted = {c: ("n", c) for c in ("listed", "new_current", "new_prior")}
        counted["new_either"] = ("n", "new_current | new_prior")
        counted["active_current"] = ("n", "CASE WHEN active THEN new_current ELSE 0L END")
        counted["active_prior"] = ("n", "CASE WHEN active THEN new_prior ELSE 0L END")
        counted |= {"orders_raised": ("coalesce(raised, 0L)", "owner"), "orders_ok": ("coalesce(done, 0L)", "owner")}
        within = _placed(self.within_buckets(params), params, {name: (f"({n})", f"({bits})") for name, (n, bits) in counted.items()})
        shared = _count_bits(self.across_buckets(params), params, "ord_id", {c: c for c in ("orders_raised", "orders_ok")})
        return finish(_summed(params, within, shared), params)
