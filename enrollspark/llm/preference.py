"""Preference formatting, turn by turn, in DataFrame operations.

Of a chosen and a rejected conversation the longest common prefix of turns is rendered once
as the prompt; what follows on either side is its completion. Every turn is a row, with the
loss mask on the assistant's completion turns only, so a conversation of any length, or one
that many pairs share, is never gathered in one row or task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"
PROMPT, CHOSEN, REJECTED = "prompt", "chosen", "rejected"


def render(role: Column, text: Column) -> Column:
    """One turn in the chat template; null role or text: empty."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, again (the place among rows of the same turn, by role and text), role, text. Null conversations are left out; a null turn stands first."""
    c = conversations.filter("conv_id is not null").select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), "role", "text")
    w = Window.partitionBy("conv_id", "turn").orderBy(F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    return c.withColumn("again", F.row_number().over(w) - 1)


def format_pairs(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """pair_id, part (prompt, chosen, rejected), turn, again, segment, trained: one row for each turn to render.

    ``pairs`` has pair_id, chosen and rejected (conversation ids). Turns are matched by
    number, then role and text (null equals null). The prompt's rows are the common
    prefix; if one conversation is a prefix of the other, or both are equal or the
    same, the shorter completion is empty. A missing conversation has no turns. The
    segments of a part in order of turn and again make its text; ``trained`` is true
    where the loss counts. Repeated pairs are rendered once.
    """
    p = pairs.select("pair_id", "chosen", "rejected").distinct()
    t = turn_rows(conversations)
    sides = [
        p.select("pair_id", F.col(side).alias("conv_id")).join(t, "conv_id").select("pair_id", F.lit(k).alias("side"), "turn", "again", "role", "text")
        for k, side in enumerate((CHOSEN, REJECTED))
    ]
    both = sides[0].union(sides[1])
    # a turn on both sides that reads the same on both
    at = Window.partitionBy("pair_id", "turn", "again")
    same = (F.count(F.lit(1)).over(at) == 2) & F.min("role").over(at).eqNullSafe(F.max("role").over(at)) & F.min("text").over(at).eqNullSafe(F.max("text").over(at))
    half = (F.count("role").over(at) != 1) & (F.count("text").over(at) != 1)
    both = both.withColumn("same", same & half)
    parted = both.filter(~F.col("same")).groupBy("pair_id").agg(F.min(F.struct("turn", "again")).alias("first"))
    d = both.join(parted, "pair_id", "left").withColumn("common", F.col("first").isNull() | (F.struct("turn", "again") < F.col("first")))
    d = d.filter(~F.col("common") | (F.col("side") == 0))
    part = F.when(F.col("common"), PROMPT).when(F.col("side") == 0, CHOSEN).otherwise(REJECTED)
    trained = ~F.col("common") & F.coalesce(F.col("role") == ASSISTANT, F.lit(False))
    return d.select("pair_id", part.alias("part"), "turn", F.col("again").cast("int").alias("again"), render(F.col("role"), F.col("text")).alias("segment"), trained.alias("trained"))


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Every even conversation, chosen, with the odd one that follows it, rejected; pair_id is half the even id."""
    ids = conversations.filter("conv_id is not null").select(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id")).distinct()
    return ids.select("pair_id", (2 * F.col("pair_id")).alias("chosen"), (2 * F.col("pair_id") + 1).alias("rejected"))


ORACLE = """
WITH t AS (
  SELECT CAST(floor(conv_id / 2.0) AS BIGINT) AS pair_id, CAST(conv_id - 2 * floor(conv_id / 2.0) AS INTEGER) AS side, coalesce(turn, -1) AS turn, role, text,
         CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) - 1 AS INTEGER) AS again
  FROM conversations WHERE conv_id IS NOT NULL
), m AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.turn, b.turn) AS turn, coalesce(a.again, b.again) AS again,
         a.pair_id IS NOT NULL AND b.pair_id IS NOT NULL AND a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text AS same
  FROM (SELECT * FROM t WHERE side = 0) a
  FULL JOIN (SELECT * FROM t WHERE side = 1) b ON a.pair_id = b.pair_id AND a.turn = b.turn AND a.again = b.again
), f AS (
  SELECT pair_id, min({'turn': turn, 'again': again}) AS first FROM m WHERE NOT same GROUP BY pair_id
), d AS (
  SELECT t.*, f.first IS NULL OR {'turn': t.turn, 'again': t.again} < f.first AS common FROM t LEFT JOIN f USING (pair_id)
)
SELECT pair_id, CASE WHEN common THEN 'prompt' WHEN side = 0 THEN 'chosen' ELSE 'rejected' END AS part, turn, again,
       '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS segment,
       NOT common AND coalesce(role = 'assistant', false) AS trained
FROM d WHERE NOT common OR side = 0
"""
