"""Queries and tables of other databases through Spark's JDBC source.

The caller names the address, the driver and the credentials; none are kept here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Driver classes by database.
DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "oracle": "oracle.jdbc.OracleDriver",
}


@dataclass(frozen=True)
class Database:
    """Where a database is. The driver class follows from the kind in the address."""

    url: str
    properties: dict[str, str] = field(default_factory=dict, repr=False)
    driver: str | None = None

    def options(self) -> dict[str, str]:
        kind = self.url.split(":")[1] if self.url.startswith("jdbc:") else ""
        driver = self.driver or DRIVERS.get(kind)
        options = {"url": self.url, **self.properties}
        if kind == "mysql":  # without it this driver ignores the number of rows to fetch
            options.setdefault("useCursorFetch", "true")
        if driver:
            options["driver"] = driver
        return options


@dataclass(frozen=True)
class Slices:
    """Ranges of a numeric or date column read by parallel connections."""

    column: str
    lower: str | int
    upper: str | int
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


# Rows a driver fetches at a time; some hold a whole result in memory otherwise.
FETCH_ROWS = 10_000


def query_options(database: Database, query: str, slices: Slices | None = None) -> dict[str, str]:
    """Options to run the query in the database; in slices it becomes a derived table."""
    text = query.strip().rstrip("; ")
    common = {"fetchsize": str(FETCH_ROWS), **database.options()}
    if slices is None:
        return {**common, "query": text}
    return {**common, "dbtable": f"({text}) sliced", **slices.options()}


def read_query(spark: SparkSession, database: Database, query: str, slices: Slices | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(database, query, slices)).load()


def read_table(spark: SparkSession, database: Database, table: str, slices: Slices | None = None) -> DataFrame:
    """A whole table; column choice and filters made on the frame go to the database."""
    options = {"fetchsize": str(FETCH_ROWS), **database.options(), "dbtable": table}
    options |= slices.options() if slices else {}
    return spark.read.format("jdbc").options(**options).load()


def append_to(df: DataFrame, database: Database, table: str, batch_rows: int = 10_000) -> None:
    """Appends rows to a table of the database, in batches per task."""
    options = {**database.options(), "dbtable": table, "batchsize": str(batch_rows)}
    df.write.format("jdbc").options(**options).mode("append").save()


def branch_list(table: DataFrame) -> DataFrame:
    """The four columns of the branch list."""
    return table.select("DONVI_ID", "TEN_NGAN", "TEN", "MA_DV")


def backlog(table: DataFrame, short: bool = False) -> DataFrame:
    """The backlog report; the long form renames two columns and has one more."""
    if short:
        return table.select(
            "PBH", "thucuoc", "cskh_ob", "cskh_ob_nc", "cskh_sla_lonhon_72", "baohong", "tuvan", "tong_ton"
        )
    return table.select(
        "PBH", "thucuoc", "cskh_ob", "cskh_ob_nc", "cskh_sla_lonhon_72", "baohong", "tuvan", "td_tocdo", "tong_ton"
    ).withColumnsRenamed({"cskh_ob_nc": "ob_nc", "cskh_sla_lonhon_72": "sla > 72"})


# ------------------------------------------------------------- equal slices

# A sketch's error is one slice over this.
FINE = 100


@dataclass(frozen=True)
class Cut:
    """Where a slice ends: before or after a key's rows, or among them at a value of the second column.

    No key is the smallest key; among a key's rows those without second value are the first.
    """

    key: float | int | None
    after: bool
    second: float | int | None = None

    def reaches(self, key: str, second: str) -> str:
        """SQL: the row is in this slice or one before."""
        early = "" if self.second is None else f"({second} <= {self.second} OR {second} IS NULL)"
        if self.key is None:
            return f"({key} IS NULL AND {early})" if early else f"{key} IS NULL"
        if early:
            return f"({key} < {self.key} OR ({key} = {self.key} AND {early}) OR {key} IS NULL)"
        return f"({key} {'<=' if self.after else '<'} {self.key} OR {key} IS NULL)"

    def beyond(self, key: str, second: str) -> str:
        """SQL: the row is in a later slice."""
        if self.key is None:
            return f"{key} IS NOT NULL" if self.second is None else f"({key} IS NOT NULL OR {second} > {self.second})"
        if self.second is not None:
            return f"({key} > {self.key} OR ({key} = {self.key} AND {second} > {self.second}))"
        return f"({key} {'>' if self.after else '>='} {self.key})"


def _place(key: Column, known: list, low: int, high: int) -> Column:
    """Where a key stands by a tree of comparisons: 2k before the k-th known one, 2k + 1 at it."""
    if low == high:
        return F.lit(2 * low)
    middle = (low + high) // 2
    left, right = _place(key, known, low, middle), _place(key, known, middle + 1, high)
    return F.when(key < known[middle], left).when(key == known[middle], F.lit(2 * middle + 1)).otherwise(right)


def slice_cuts(rows: DataFrame, key: str, second: str, slices: int) -> list[Cut]:
    """Cuts that deal rows into slices of nearly equal size by a number column, hot keys included.

    Rows are counted, then the quantiles of the key sketched, then the rows between and at the
    keys found there counted. Where a cut falls among the many rows of one key, or among those
    without, a last pass over these alone sketches the second column, also a number, and the key is
    cut there. Rows that share both values stay together, so slices differ by as much as these
    have. Where different rows are fewer than slices, so are the cuts. The driver sees a few
    figures for each slice, however many keys there are.
    """
    if slices < 1:
        raise ValueError("there must be a slice")
    total, missing = rows.agg(F.count(F.lit(1)), F.count_if(F.col(key).isNull())).first()
    ends_at = [i * total / slices for i in range(1, slices)]
    shares = [(end - missing) / (total - missing) for end in ends_at if end > missing]
    known: list = []
    if shares:
        known = sorted(set(rows.agg(F.percentile_approx(key, shares, FINE * slices).alias("keys")).first()["keys"]))
    place = F.when(F.col(key).isNotNull(), _place(F.col(key), known, 0, len(known)))
    figures = (F.count(F.lit(1)).alias("n"), F.count_if(F.col(second).isNull()).alias("bare"))
    sizes = {r["place"]: (r["n"], r["bare"]) for r in rows.groupBy(place.alias("place")).agg(*figures).collect()}
    steps = [(None, *sizes[None], sizes.get(0, (0,))[0])] if missing else []
    steps += [(value, *sizes[2 * k + 1], sizes.get(2 * k + 2, (0,))[0]) for k, value in enumerate(known)]
    before = 0 if missing else sizes.get(0, (0,))[0]
    targets: list[tuple[float | int | None, float]] = []
    for step, (value, own, bare, gap) in enumerate(steps, start=1):
        while ends_at and (step == len(steps) or ends_at[0] <= before + own + gap / 2):
            rows_of = ends_at.pop(0) - before
            share = float(round(rows_of / own))
            if 0 < rows_of < own and own > total / (slices * FINE) and own > bare:
                # The sketch knows the rows that have a second value; those without one go before.
                share = max(rows_of - bare, 0.5) / (own - bare)
            targets.append((value, share))
        before += own + gap
    inside = sorted({share for _, share in targets if 0 < share < 1})
    hot = {value for value, share in targets if 0 < share < 1}
    points: dict = {}
    if hot:
        among = F.col(key).isin([v for v in hot if v is not None])
        among = among | F.col(key).isNull() if None in hot else among
        sketch = F.percentile_approx(second, inside, FINE * slices).alias("points")
        cut = rows.where(among).groupBy(F.col(key).alias("key")).agg(sketch).collect()
        points = {r["key"]: dict(zip(inside, r["points"] or [], strict=False)) for r in cut}
    cuts = [Cut(value, share >= 0.5, points.get(value, {}).get(share) if 0 < share < 1 else None) for value, share in targets]
    return list(dict.fromkeys(cuts))


def slice_conditions(cuts: list[Cut], key: str, second: str) -> list[str]:
    """SQL conditions of the slices; each row meets one of them."""
    if not cuts:
        return ["1 = 1"]
    middle = [f"{a.beyond(key, second)} AND {b.reaches(key, second)}" for a, b in zip(cuts, cuts[1:])]
    return [cuts[0].reaches(key, second), *middle, cuts[-1].beyond(key, second)]


def read_slices(spark: SparkSession, database: Database, table: str, conditions: list[str]) -> DataFrame:
    """A table read by one connection for each condition."""
    options = {"fetchsize": str(FETCH_ROWS), **database.options()}
    return spark.read.jdbc(options.pop("url"), table, predicates=conditions, properties=options)
