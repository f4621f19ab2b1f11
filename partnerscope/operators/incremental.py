"""The report kept up to date: exact state that batches are merged into, in place of all rows.

A batch of partners becomes one row of department bits for each code, a batch of orders one row
for each code and order id of the year. Such facts merge by ``bit_or`` and ``bool_or``: in any
order, and a row that comes again, in the same batch or a later one, changes nothing. Each batch
is written once under a name of its own, and writing it again replaces it; the feeds behind it
are never read again. ``compact`` merges what has piled up into one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partnerscope.operators.measures import listed_partners, order_facts
from partnerscope.operators.report import _bit, _count_bits, _summed, finish
from partnerscope.params import ReportParams

BITS = ("listed", "new_current", "new_prior", "owner")


def partner_facts(partners: DataFrame, params: ReportParams) -> DataFrame:
    """``code`` with the bits of the departments that it is listed, new and verified in."""
    bit = _bit(params)
    within = {"listed": "true", "new_current": "is_current", "new_prior": "is_prior", "owner": "verified"}
    bits = [F.expr(f"bit_or(CASE WHEN {test} THEN {bit} ELSE 0L END) AS {name}") for name, test in within.items()]
    return listed_partners(partners, params).groupBy("code").agg(*bits)


def merged_partners(facts: DataFrame) -> DataFrame:
    return facts.groupBy("code").agg(*[F.expr(f"bit_or({b}) AS {b}") for b in BITS])


def merged_orders(facts: DataFrame) -> DataFrame:
    return facts.groupBy("code", "ord_id").agg(F.expr("bool_or(ok) AS ok"))


def report_from_facts(partners: DataFrame, orders: DataFrame, params: ReportParams) -> DataFrame:
    """The report of merged facts, unordered; the same rows as ``partner_report`` has of the feeds."""
    done = orders.groupBy("code").agg(F.expr("bool_or(ok) AS active")).where("active")
    bits = partners.select("code", "listed", "new_current", "new_prior").join(done, "code", "left")
    counted = {c: c for c in ("listed", "new_current", "new_prior")} | {"new_either": "new_current | new_prior"}
    counted["active_current"] = "CASE WHEN active THEN new_current ELSE 0L END"
    counted["active_prior"] = "CASE WHEN active THEN new_prior ELSE 0L END"
    owners = partners.where("owner <> 0").select("code", "owner")
    owned = "CASE WHEN ord_id IS NOT NULL THEN owner ELSE 0L END"
    per_order = (
        orders.join(owners, "code")
        .groupBy("ord_id")
        .agg(F.expr(f"bit_or({owned}) AS orders_raised"), F.expr(f"bit_or(CASE WHEN ok THEN {owned} ELSE 0L END) AS orders_ok"))
    )
    counts = (
        _count_bits(bits, params, "code", counted),
        _count_bits(per_order, params, "ord_id", {c: c for c in ("orders_raised", "orders_ok")}),
    )
    return finish(_summed(params, *counts), params)


@dataclass(frozen=True)
class ReportState:
    """The state in a folder of the shared store, for one set of parameters.

    Codes must have one type in all batches. One writer at a time; readers see whole batches only,
    as a batch is a folder that Spark publishes at the end of its write.
    """

    spark: SparkSession
    folder: str
    params: ReportParams

    def add(self, batch: str, partners: DataFrame | None = None, orders: DataFrame | None = None) -> None:
        """Takes a batch of one or both feeds in. A batch of the same name is replaced."""
        if partners is not None:
            self._write(partner_facts(partners, self.params), "partners", batch)
        if orders is not None:
            self._write(order_facts(orders, self.params), "orders", batch)

    def report(self) -> DataFrame:
        """The report of all batches, from their facts alone."""
        return report_from_facts(merged_partners(self.facts("partners")), merged_orders(self.facts("orders")), self.params)

    def facts(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{kind}").drop("batch")

    def compact(self, name: str) -> None:
        """Merges the batches of both feeds into one of this name, and frees the others.

        Stopped in between, both are there, which changes no report.
        """
        for kind, merge in (("partners", merged_partners), ("orders", merged_orders)):
            before = self._batches(kind)
            if name in before:
                raise ValueError(f"there is a batch {name} already")
            self._write(merge(self.facts(kind)), kind, name)
            for batch in before:
                path = self._path(f"{self.folder}/{kind}/batch={batch}")
                self._store(path).delete(path, True)

    def _write(self, facts: DataFrame, kind: str, batch: str) -> None:
        facts.write.mode("overwrite").parquet(f"{self.folder}/{kind}/batch={batch}")

    def _batches(self, kind: str) -> list[str]:
        path = self._path(f"{self.folder}/{kind}")
        return [s.getPath().getName().removeprefix("batch=") for s in self._store(path).listStatus(path)]

    def _path(self, place: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(place)

    def _store(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())
