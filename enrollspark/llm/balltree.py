"""Exact top-k search by inner product: a ball tree per shard, searched by branch and bound.

Vectors are dealt to shards of bounded size; every shard's ball tree is built once and
staged. Queries travel to the trees. A query's product with any vector in a ball is at
most q.c + |q| r, so a query descends from the root, into the child with the higher bound
first, and leaves a subtree as soon as its bound is below the query's k-th score. Every
query first descends one tree; its k-th score there is the bar with which it enters the
others.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrollspark.llm.common import stage
from enrollspark.llm.shards import by_length, deal_rows, visit_shards, wide

TOP = 5
SCALE = 256
SHARD_ROWS = 8192
QUERIES = 1024  # queries that descend together
LEAF = 128
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def integer_vector(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as a long (beyond a long: its limit); null if null, or a component is null or not finite."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    return F.when(F.size(embedding) == 0, F.array().cast("array<bigint>")).when(~bad, whole)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products, beyond a long its limit; ``q`` and ``x`` are arrays of longs."""
    most = (int(np.abs(q.astype(object)).max()) if q.size else 0) * (int(np.abs(x.astype(object)).max()) if x.size else 0) * max(1, q.shape[1])
    if most < 1 << 53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    if most < 1 << 63:
        return q @ x.T
    return np.clip(q.astype(object) @ x.astype(object).T, LOWEST, HIGHEST).astype(np.int64)


class BallTree:
    """Vectors of one length in a tree of balls: node n holds the rows start[n] to end[n] and has the children child[n] and child[n] + 1, or none (0)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, nodes: dict[str, np.ndarray]) -> None:
        self.ids, self.x = ids, x
        self.centre, self.radius, self.start, self.end, self.child = (nodes[k] for k in ("centre", "radius", "start", "end", "child"))
        self.cut = self.scored = 0  # subtrees that queries left out, and products taken

    @classmethod
    def build(cls, ids: np.ndarray, x: np.ndarray) -> BallTree:
        f, order = x.astype(float), np.arange(len(x))
        start, end, centre, radius, child = [0], [len(x)], [], [], []
        at = 0
        while at < len(start):
            rows = order[start[at] : end[at]]
            v = f[rows]
            middle = v.mean(0)
            far = np.sqrt(((v - middle) ** 2).sum(1))
            centre.append(middle)
            radius.append(float(far.max()))
            child.append(0)
            if len(rows) > LEAF:  # equal vectors too, so that no leaf is large
                a = v[np.argmax(far)]
                b = v[np.argmax(((v - a) ** 2).sum(1))]
                order[start[at] : end[at]] = rows[np.argsort(v @ (b - a), kind="stable")]
                half = (start[at] + end[at]) // 2
                child[at] = len(start)
                start += [start[at], half]
                end += [half, end[at]]
            at += 1
        nodes = {"centre": np.array(centre), "radius": np.array(radius), "start": np.array(start), "end": np.array(end), "child": np.array(child)}
        return cls(ids[order], x[order], nodes)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, x=self.x, centre=self.centre, radius=self.radius, start=self.start, end=self.end, child=self.child)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> BallTree:
        with np.load(io.BytesIO(data)) as made:
            return cls(made["ids"], made["x"], {k: made[k] for k in ("centre", "radius", "start", "end", "child")})

    def search(self, qids: np.ndarray, q: np.ndarray, bar: np.ndarray, k: int = TOP) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids), query x k: each query's best that reach its ``bar``, ties to the smaller id, its own id left out; LOWEST, HIGHEST where there are fewer."""
        score = np.full((len(qids), k), LOWEST, np.int64)
        who = np.full((len(qids), k), HIGHEST, np.int64)
        qf = q.astype(float)
        norm = np.sqrt((qf * qf).sum(1))
        kth = bar.astype(float)

        def bound(node: int, live: np.ndarray) -> np.ndarray:
            b = qf[live] @ self.centre[node] + norm[live] * self.radius[node]
            return b + 1e-9 * (np.abs(b) + norm[live] * self.radius[node]) + 1.0  # floating point rounds

        def leaf(node: int, live: np.ndarray) -> None:
            rows = slice(self.start[node], self.end[node])
            p = products(q[live], self.x[rows])
            self.scored += p.size
            ids = self.ids[rows][None, :]
            good = (p >= np.maximum(bar, score[:, -1])[live][:, None]) & (ids != qids[live][:, None])
            hit = good.any(1)
            if not hit.any():
                return
            mine, good = live[hit], good[hit]
            s = np.concatenate([score[mine], np.where(good, p[hit], LOWEST)], 1)
            w = np.concatenate([who[mine], np.where(good, ids, HIGHEST)], 1)
            best = np.lexsort((w, ~s), axis=1)[:, :k]  # ~s falls as s rises and never overflows
            score[mine], who[mine] = np.take_along_axis(s, best, 1), np.take_along_axis(w, best, 1)
            kth[mine] = np.maximum(kth[mine], score[mine][:, -1].astype(float))

        def descend(node: int, live: np.ndarray, most: np.ndarray) -> None:
            """``most`` is the node's bound for each of ``live``; the k-th score may have risen since it was taken."""
            on = np.maximum(most, LOWEST) >= kth[live]
            self.cut += len(live) - int(on.sum())
            live = live[on]
            if not len(live):
                return
            left = self.child[node]
            if not left:
                return leaf(node, live)
            a, b = bound(left, live), bound(left + 1, live)
            first = a >= b
            descend(left, live[first], a[first])
            descend(left + 1, live, b)
            descend(left, live[~first], a[~first])

        if len(qids) and len(self.ids):
            live = np.arange(len(qids))
            descend(0, live, bound(0, live))
        return score, who


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    """A shard's trees, one for each length of vector."""
    made = [(int(rows["shard"].iloc[0]), n, BallTree.build(some["vec_id"].to_numpy(np.int64), wide(some["vec"], n)).to_bytes()) for n, some in by_length(rows)]
    return pd.DataFrame(made, columns=["shard", "length", "tree"])


class TreeShard:
    def __init__(self, rows: pd.DataFrame, k: int) -> None:
        self.trees = {int(n): BallTree.from_bytes(t) for n, t in zip(rows["length"], rows["tree"])}
        self.k = k

    def visit(self, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for n, some in by_length(rows):
            for at in range(0, len(some) if n in self.trees else 0, QUERIES):
                part = some.iloc[at : at + QUERIES]
                qids = part["query_id"].to_numpy(np.int64)
                score, who = self.trees[n].search(qids, wide(part["vec"], n), part["bar"].to_numpy(np.int64), self.k)
                i, j = np.nonzero(who < HIGHEST)
                yield pd.DataFrame({"query_id": qids[i], "vec_id": who[i, j], "score": score[i, j]})

    def close(self) -> Iterator[pd.DataFrame]:
        yield from ()


def top_products(vectors: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of ``vectors`` (vec_id, vec) for each of ``queries`` (query_id, vec).

    Vectors are arrays of longs. A row with a null id or vector takes no part, nor
    does a vector of another length than the query's, nor one with the query's own
    id. A repeated query is one query; repeated vectors count as often as they
    come. Ties go to the smaller id.
    """
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vec").dropna()
    q = queries.select(F.col("query_id").cast("long").alias("query_id"), "vec").dropna().groupBy("query_id").agg(F.min("vec").alias("vec"))
    x, shards = deal_rows(stage(x, "vectors"), SHARD_ROWS)
    trees = stage(x.repartitionById(shards, F.col("shard")).groupBy("shard").applyInPandas(_build, "shard int, length int, tree binary"), "trees")
    home = F.pmod(F.xxhash64("query_id"), F.lit(shards)).cast("int")
    q = stage(q.withColumn("home", home), "queries")

    def search(at: DataFrame) -> DataFrame:
        return visit_shards(trees, at, shards, lambda _, rows: TreeShard(rows, k), "query_id long, vec_id long, score long")

    first = stage(search(q.select("query_id", "vec", F.col("home").alias("shard"), F.lit(LOWEST).alias("bar"))), "first")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = first
    if shards > 1:
        bars = first.select("query_id", "score", F.row_number().over(w).alias("rank")).filter(F.col("rank") == k).select("query_id", F.col("score").alias("bar"))
        rest = q.join(bars, "query_id", "left").withColumn("bar", F.coalesce("bar", F.lit(LOWEST)))
        rest = rest.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("shard <> home").drop("home")
        found = first.union(search(rest))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def embedding_top(embeddings: DataFrame, every: int = 50, k: int = TOP) -> DataFrame:
    """The k best of all rows for the rows whose vec_id is divisible by ``every``."""
    v = embeddings.select("vec_id", integer_vector(F.col("embedding")).alias("vec"))
    q = v.filter(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    return top_products(v, q, k)


ORACLE = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND NOT list_contains([coalesce(isfinite(x), false) FOR x IN embedding], false)
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(q.e) = len(v.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
