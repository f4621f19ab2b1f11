"""Connected components of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerscope.llm.common import Work


def components(links: DataFrame, work: Work) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with, for every linked node.

    ``links`` has columns ``a`` and ``b``. Each round, a node takes the least label among itself
    and its neighbours, and then the label of that label, so that the distance covered doubles.
    Labels only fall, so their sum tells when none did. No node's links are gathered in one
    place: labels are least values of groups, which combine before they are moved.
    """
    ways = [F.struct(F.col(x).alias("node"), F.col(y).alias("other")) for x, y in ("ab", "ba", "aa", "bb")]
    pairs = links.select(F.explode(F.array(*ways)).alias("p"))
    both = work.keep(pairs.select("p.node", "p.other").distinct(), "edges")
    first = both.groupBy("node").agg(F.min("other").alias("label"))
    labels, total = work.keep_summed(first, "labels", F.col("label"))
    while True:
        near = labels.select(F.col("node").alias("other"), F.col("label").alias("near"))
        beyond = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        stepped = both.join(near, "other").groupBy("node").agg(F.min("near").alias("mid"))
        jumped = stepped.join(beyond, "mid").select("node", F.least("mid", "far").alias("label"))
        following, fallen = work.keep_summed(jumped, "labels", F.col("label"))
        work.drop(labels)
        labels = following
        if fallen == total:
            work.drop(both)
            return labels
        total = fallen
