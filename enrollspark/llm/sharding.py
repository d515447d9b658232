"""Sharding by a weighted hash tree: region, rack, shard.

A row descends the tree. At each node every child draws ``ln(u) / weight`` with u from a
hash of the row's key, the level and the child, and the largest draw wins; a child is
then taken in proportion to its weight, and a child's draw depends on nothing but its
own weight. If weights change, rows move only into subtrees that became heavier and
out of those that became lighter; no row moves between two others. A shard that is
added opens a region of its own, so rows move into that shard alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrollspark.llm.common import number_rows, private, text_or_empty

SEED = 17
SHARDS = 16
RACKS_PER_REGION, SHARDS_PER_RACK = 2, 2

Tree = tuple[tuple[tuple[tuple[int, float], ...], ...], ...]  # regions of racks of (shard, weight)


def shard_tree(shards: int, base: int = SHARDS) -> Tree:
    """The first ``base`` shards, of weight 1, in regions of 2 racks of 2; each further shard is a region of its own."""
    n = min(shards, base)
    racks = [tuple((s, 1.0) for s in range(k, min(n, k + SHARDS_PER_RACK))) for k in range(0, n, SHARDS_PER_RACK)]
    regions = [tuple(racks[k : k + RACKS_PER_REGION]) for k in range(0, len(racks), RACKS_PER_REGION)]
    return (*regions, *((((s, 1.0),),) for s in range(n, shards)))


def _weight(node) -> float:
    """The weight of a rack or region: the sum of its shards' weights."""
    return node[1] if isinstance(node[0], int) else sum(_weight(c) for c in node)


def _first(node) -> int:
    """A node's name: its first shard, which no later shard changes."""
    return node[0] if isinstance(node[0], int) else _first(node[0])


def _draw(key: Column, level: int, node) -> Column:
    """ln(u) / weight; u is in (0, 1) from the top 53 bits of the hash."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.lit(level), F.lit(_first(node)), key), 11)
    return F.log((bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(_weight(node)))


def descend(key: Column, node, level: int = 0) -> Column:
    """The shard that ``key`` reaches below ``node``; equal draws go to the child that stands first."""
    if isinstance(node[0], int):
        return F.lit(node[0])
    live = [c for c in node if _weight(c) > 0]
    if len(live) == 1:
        return descend(key, live[0], level + 1)
    draws = [_draw(key, level, c) for c in live]
    most = F.greatest(*draws)
    out = descend(key, live[-1], level + 1)
    for c, d in reversed(list(zip(live[:-1], draws[:-1]))):
        out = F.when(d == most, descend(key, c, level + 1)).otherwise(out)
    return out


def assign_shards(docs: DataFrame, tree: Tree, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """Add ``out``: the shard of each row. Null keys are one key; equal keys share a shard; other columns stay."""
    k = text_or_empty(F.col(key).cast("string"))
    return docs.select("*", descend(k, tree).cast("int").alias(out))


def place_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for every row.

    ``size`` is the text's UTF-8 bytes (null: none) plus 1. ``slot`` numbers the rows
    of a shard gaplessly from 0, in hash order; rows with the same id and text may
    change places. An empty table gives an empty result.
    """
    t = text_or_empty(F.col("text"))
    d = docs.select("doc_id", (F.octet_length(t).cast("long") + 1).alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"))
    d = assign_shards(d, shard_tree(shards))
    d = assign_shards(d, shard_tree(shards + 1), out="grown_shard")
    # the rows' text is left behind before they are numbered
    d = number_rows(d, "shard", [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "slot")
    return d.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def movement(docs: DataFrame, before: Tree, after: Tree, key: str = "doc_id") -> DataFrame:
    """Rows that change shard, by old and new shard."""
    a, b = private(docs, "old_shard", "new_shard")
    d = assign_shards(assign_shards(docs.select(key), before, key, a), after, key, b)
    return d.filter(F.col(a) != F.col(b)).groupBy(F.col(a).alias("old_shard"), F.col(b).alias("new_shard")).agg(F.count(F.lit(1)).alias("rows"))
