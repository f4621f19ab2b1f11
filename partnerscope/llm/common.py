"""What the operators share: input tables, the work folder, words."""

from __future__ import annotations

import os
import re
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters that are none of these.
BLANKS = " \t\n\v\f\r"
WORD = re.compile(f"[^{BLANKS}]+")


def with_package(spark: SparkSession) -> SparkSession:
    """Lets Python workers find this package where it lies, whatever folder the session was started
    in. On machines without it the submitter sends it along (``--py-files``)."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return with_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; else one in the warehouse, which is shared too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/shared").rstrip("/")


class Work:
    """Tables of one run in the shared folder.

    Each cuts the lineage: what follows reads files that stay, so a lost executor runs
    only its own tasks again. ``drop`` frees tables that nothing reads any more, ``finish``
    all but the result.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = with_package(spark)
        self.folder = f"{shared_folder(spark)}/llm/{purpose}-{uuid.uuid4().hex}"
        self.kept: list[tuple[DataFrame, str]] = []
        self.number = 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """The frame as a written table."""
        self.number += 1
        place = f"{self.folder}/{name}-{self.number}"
        df.write.option("compression", "zstd").parquet(place)
        written = self.spark.read.schema(df.schema).parquet(place)
        self.kept.append((written, place))
        return written

    def keep_summed(self, df: DataFrame, name: str, value: Column) -> tuple[DataFrame, int]:
        """The frame as a written table, and the sum of a value over its rows, found on the way."""
        seen = Observation()
        kept = self.keep(df.observe(seen, F.sum(value.cast("decimal(38,0)")).alias("sum")), name)
        return kept, int(seen.get["sum"] or 0)

    def finish(self, df: DataFrame) -> DataFrame:
        """The run's result as a written table; all others of the run are freed."""
        others = [kept for kept, _ in self.kept]
        result = self.keep(df, "result")
        self.drop(*others)
        return result

    def drop(self, *frames: DataFrame) -> None:
        """Frees tables that ``keep`` returned."""
        for entry in [e for e in self.kept if any(e[0] is df for df in frames)]:
            self.kept.remove(entry)
            self.remove(entry[1])

    def remove(self, place: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def buckets(spark: SparkSession) -> int:
    """How many parts a group is split into: as many as the session's shuffles have."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def two_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text only, under fixed names, so that other columns can't clash; null text is empty."""
    with_package(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    )
