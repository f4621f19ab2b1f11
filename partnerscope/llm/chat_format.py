"""Chat formatting: logged snapshots of conversations collapsed, the longest ones rendered.

A conversation that is logged again after every turn leaves prefixes of itself. Each turn gets a
rolling hash of all turns up to it (an exclusive or of hashes of place, role and text, twice 64
bits, as a running window over the conversation). A conversation whose last hash is also the hash
of an inner turn of another one is a prefix of it; an anti-join removes it. Of equal conversations
the one with the smallest id stays. A first turn or a whole conversation that many share is one
row on either side of that join, as hashes are made distinct before.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerscope.llm.common import Work

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"


def turns(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation, without those that have no conversation; null role and text are empty."""
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def prefix_hashes(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``a`` and ``b``, the hash up to it, and whether it is the last."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    repeated = (
        F.col("turn").eqNullSafe(F.lag("turn").over(order))
        & F.col("role").eqNullSafe(F.lag("role").over(order))
        & F.col("text").eqNullSafe(F.lag("text").over(order))
        & (F.row_number().over(order) > 1)
    )
    placed = (
        rows.withColumn("repeated", repeated)
        .where("NOT repeated")
        .withColumn("place", F.row_number().over(order))
        .withColumn("last", F.lead("place").over(order).isNull())
        .withColumn("one", F.xxhash64("place", "role", "text"))
        .withColumn("two", F.xxhash64("text", "place", "role", F.lit("two")))
    )
    return placed.select(
        "conv_id", "place", "last", F.bit_xor("one").over(so_far).alias("a"), F.bit_xor("two").over(so_far).alias("b")
    )


def maximal(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns`` and ``n_copies`` of conversations that are no prefix of a longer one."""
    hashes = Work(conversations.sparkSession, "chat").keep(prefix_hashes(turns(conversations)), "hashes")
    whole = (
        hashes.where("last")
        .groupBy("a", "b", "place")
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    )
    inner = hashes.where("NOT last").select("a", "b", "place").distinct()
    kept = whole.join(inner, ["a", "b", "place"], "left_anti")
    return kept.select("conv_id", F.col("place").cast("long").alias("n_turns"), "n_copies")


def rendered_turn(turn: Column) -> Column:
    """One turn; what looks like a marker in it is broken up."""
    own = F.replace(turn["text"], F.lit("<|"), F.lit("< |"))
    role = F.replace(turn["role"], F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(TURN_START), role, F.lit("\n"), own, F.lit(TURN_END), F.lit("\n"))


def formatted(conversations: DataFrame) -> DataFrame:
    """Maximal conversations as one text each.

    Turns are ordered by turn (without one first), role and text; rows repeated exactly are one
    turn. Null roles and texts are empty; rows without conversation id belong to none. No rows
    give no rows; other columns are left out. ``n_copies`` counts equal conversations.
    """
    kept = maximal(conversations).withColumnRenamed("conv_id", "kept_id")
    whole = (
        turns(conversations)
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    )
    text = F.array_join(F.transform("turns", rendered_turn), "")
    return whole.join(kept, F.col("conv_id") == F.col("kept_id")).select("conv_id", "n_turns", "n_copies", text.alias("text"))


ORACLE_SQL = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
         list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS said,
         string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |')
           || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS text
  FROM turns GROUP BY conv_id
), inner_turns AS (
  SELECT DISTINCT said[1:k] AS said
  FROM (SELECT said, unnest(range(1, n_turns)) AS k FROM whole)
), kept AS (
  SELECT min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_copies, any_value(text) AS text
  FROM whole WHERE NOT EXISTS (SELECT 1 FROM inner_turns i WHERE i.said = whole.said)
  GROUP BY said
)
SELECT conv_id, n_turns, n_copies, text FROM kept
"""
