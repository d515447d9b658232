"""Hard-negative mining with segment summaries.

A vector is cut into segments, and each segment is summed up by its mean and deviation.
The product of two segments of length L is L times the product of the means, more or less
at most L times the product of the deviations. Summed over the segments this bounds the
inner product from both sides. Pairs that the bounds of few long segments can't rule out
are bounded anew by more, shorter segments, and only what is then left is multiplied out.

Vectors are dealt to shards of bounded size, and anchors travel to the shards. Every
anchor first visits one shard; its last score there is the bar with which it enters the
others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from enrollspark.llm.balltree import HIGHEST, LOWEST, integer_vector, products
from enrollspark.llm.common import stage
from enrollspark.llm.shards import by_length, deal_rows, visit_shards, wide

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a hard negative scores between these percentages of its positive
SEGMENTS = (4, 16)  # of the coarse and of the refined summary
SHARD_ROWS = 8192
ROWS = 1024  # rows of a shard that are bounded together, after which the bar rises
ANCHORS = 256  # anchors that are bounded together


def summary(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every row and segment: mean and deviation, both times the root of the segment's length, so that plain products bound."""
    cuts = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    if x.shape[1] == 0:
        return np.zeros((len(x), 1)), np.zeros((len(x), 1))
    root = np.sqrt(np.diff(cuts))
    mean = np.stack([x[:, a:b].mean(1) for a, b in zip(cuts, cuts[1:])], 1)
    dev = np.stack([x[:, a:b].std(1) for a, b in zip(cuts, cuts[1:])], 1)
    return mean * root, dev * root


def bounds(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest that the product of each row of ``a`` and each of ``b`` can be; floating point rounds, so a little wider."""
    middle, more = a[0] @ b[0].T, a[1] @ b[1].T
    slack = 1.0 + 1e-9 * (np.abs(a[0]) @ np.abs(b[0]).T + more)
    return middle - more - slack, middle + more + slack


class SegmentShard:
    """A shard's vectors, of one length each, with their summaries; ``counts`` tells how many pairs each step looked at."""

    def __init__(self, rows: pd.DataFrame, same: bool, want: int) -> None:
        self.same, self.want = same, want
        self.counts = np.zeros(len(SEGMENTS) + 2, np.int64)
        self.lengths = {}
        for n, some in by_length(rows):
            x = wide(some["vec"], n)
            f = x.astype(float)
            self.lengths[n] = (some["vec_id"].to_numpy(np.int64), some["label"].to_numpy(np.int64), x, [summary(f, s) for s in SEGMENTS])

    def search(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, vec_ids) of shape anchor x range x want: the best of each score range [low, high], ties to the smaller id; LOWEST, HIGHEST where there are fewer."""
        score = np.full((*low.shape, self.want), LOWEST, np.int64)
        who = np.full((*low.shape, self.want), HIGHEST, np.int64)
        if q.shape[1] not in self.lengths or not len(ids):
            return score, who
        vec_ids, vec_labels, x, made = self.lengths[q.shape[1]]
        mine = [summary(q.astype(float), s) for s in SEGMENTS]
        open_, top = low <= high, np.where(low <= high, high, LOWEST).max(1).astype(float)
        for at in range(0, len(x), ROWS):
            sl = slice(at, at + ROWS)
            # the least score that still counts in one of the anchor's ranges
            bar = np.where(open_, np.maximum(low, score[:, :, -1]), HIGHEST).min(1).astype(float)
            alike = labels[:, None] == vec_labels[sl][None, :]
            left = (alike if self.same else ~alike) & (ids[:, None] != vec_ids[sl][None, :]) & open_.any(1)[:, None]
            self.counts[0] += left.sum()
            for level in range(len(SEGMENTS)):
                a, b = np.flatnonzero(left.any(1)), np.flatnonzero(left.any(0))
                if not len(a):
                    break
                lo, hi = bounds(tuple(m[a] for m in mine[level]), tuple(m[sl][b] for m in made[level]))
                cell = np.ix_(a, b)
                # products end at a long's limits
                left[cell] &= (np.maximum(hi, LOWEST) >= bar[a][:, None]) & (np.minimum(lo, HIGHEST) <= top[a][:, None])
                self.counts[level + 1] += left.sum()
            a, b = np.flatnonzero(left.any(1)), np.flatnonzero(left.any(0))
            if not len(a):
                continue
            p = products(q[a], x[sl][b])
            self.counts[-1] += left.sum()
            near = np.broadcast_to(vec_ids[sl][b], p.shape)
            for r in range(low.shape[1]):
                good = left[np.ix_(a, b)] & (p >= low[a, r][:, None]) & (p <= high[a, r][:, None]) & (p >= score[a, r, -1][:, None])
                some = np.flatnonzero(good.any(1))
                if not len(some):
                    continue
                s = np.concatenate([score[a[some], r], np.where(good, p, LOWEST)[some]], 1)
                w = np.concatenate([who[a[some], r], np.where(good, near, HIGHEST)[some]], 1)
                best = np.lexsort((w, ~s), axis=1)[:, : self.want]  # ~s falls as s rises and never overflows
                score[a[some], r], who[a[some], r] = np.take_along_axis(s, best, 1), np.take_along_axis(w, best, 1)
        return score, who

    def visit(self, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for n, some in by_length(rows):
            for at in range(0, len(some), ANCHORS):
                part = some.iloc[at : at + ANCHORS]
                ids = part["anchor_id"].to_numpy(np.int64)
                low, high = (np.array(part[c].tolist(), np.int64).reshape(len(part), -1) for c in ("low", "high"))
                score, who = self.search(ids, part["label"].to_numpy(np.int64), wide(part["vec"], n), low, high)
                i, r, k = np.nonzero(who < HIGHEST)
                yield pd.DataFrame({"anchor_id": ids[i], "range": r, "vec_id": who[i, r, k], "score": score[i, r, k]})

    def close(self) -> Iterator[pd.DataFrame]:
        yield from ()


def best_in_ranges(vectors: DataFrame, shards: int, anchors: DataFrame, same: bool, want: int) -> DataFrame:
    """anchor_id, range, rank (from 1), vec_id, score: the ``want`` best of each of an anchor's score ranges.

    ``vectors`` has shard, vec_id, label, vec; ``anchors`` has anchor_id, label, vec and the
    arrays low and high, a range in each place. ``same`` takes vectors of the anchor's
    label, otherwise those of other labels; a vector with the anchor's id is never taken.
    """
    schema = "anchor_id long, range int, vec_id long, score long"

    def search(at: DataFrame) -> DataFrame:
        return visit_shards(vectors, at, shards, lambda _, rows: SegmentShard(rows, same, want), schema)

    home = F.pmod(F.xxhash64("anchor_id"), F.lit(shards)).cast("int")
    w = Window.partitionBy("anchor_id", "range").orderBy(F.desc("score"), "vec_id")
    first = stage(search(anchors.withColumn("shard", home)), "first")
    found = first
    if shards > 1:
        # a range that is full enters the other shards with its last score as the bar
        bars = first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") == want)
        bars = bars.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("range", "score"))).alias("bars"))
        rest = anchors.join(bars, "anchor_id", "left")
        low = F.transform("low", lambda v, r: F.greatest(v, F.coalesce(F.try_element_at("bars", r), v)))
        rest = rest.withColumn("low", low).drop("bars").withColumn("home", home)
        rest = rest.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("shard <> home").drop("home")
        found = first.union(search(rest))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= want).select("anchor_id", "range", "rank", "vec_id", "score")


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and vec, an array of longs, ``anchors`` anchor_id, label
    and vec. An anchor's positives are the ``positives`` best other vectors of its label;
    for each of them come the ``negatives`` best vectors of other labels that score
    ``low`` to ``high`` percent of it. Rows with a null take no part, nor do vectors
    of another length than the anchor's or with its id. A repeated vector counts as
    often as it comes; of anchors with one id the one with the least label and vector
    is taken. Ties go to the smaller id; an empty table gives an empty result.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "vec").dropna()
    a = anchors.select(F.col("anchor_id").cast("long").alias("anchor_id"), F.col("label").cast("long").alias("label"), "vec").dropna()
    a = a.groupBy("anchor_id").agg(F.min(F.struct("label", "vec")).alias("a")).select("anchor_id", "a.label", "a.vec")
    v, shards = deal_rows(stage(v, "vectors"), SHARD_ROWS)
    a = stage(a, "anchors")
    every = lambda x: F.array(F.lit(x).cast("long"))
    near = best_in_ranges(v, shards, a.withColumn("low", every(LOWEST)).withColumn("high", every(HIGHEST)), True, positives)
    near = stage(near.select("anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # at most ``positives`` rows for an anchor, in the order of their place; decimals don't overflow
    share = lambda x, percent: x["positive_score"].cast("decimal(24,0)") * F.lit(percent).cast("decimal(4,0)") / F.lit(100).cast("decimal(4,0)")
    ranges = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("ps"))
    ranges = ranges.select(
        "anchor_id",
        F.transform("ps", lambda x: F.ceil(share(x, low)).cast("long")).alias("low"),
        F.transform("ps", lambda x: F.floor(share(x, high)).cast("long")).alias("high"),
    )
    far = best_in_ranges(v, shards, a.join(ranges, "anchor_id"), False, negatives)
    return far.join(near, (far["anchor_id"] == near["anchor_id"]) & (far["range"] + 1 == near["place"])).select(
        far["anchor_id"], "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def embedding_negatives(embeddings: DataFrame, every: int = 50, flip: int = 7, labels: int = 10, scale: int = 256) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by ``every``; where it is divisible by ``flip``, label becomes (label + 1) % ``labels`` first.

    Rows with a null id, label or vector, or a null or non-finite component, take no part.
    """
    label = F.col("label").cast("long")
    v = embeddings.select(
        "vec_id",
        F.when(F.col("vec_id") % flip == 0, (label + 1) % labels).otherwise(label).alias("label"),
        integer_vector(F.col("embedding"), scale).alias("vec"),
    )
    return hard_negatives(v, v.filter(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "anchor_id"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND NOT list_contains([coalesce(isfinite(x), false) FOR x IN embedding], false)
), s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS alike, CAST(list_dot_product(a.e, v.e) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id % 50 = 0 AND v.vec_id <> a.vec_id AND len(v.e) = len(a.e)
), p AS (
  SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
