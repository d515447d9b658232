"""Quality classifier: a sparse rule ensemble over text statistics.

1. Shallow regression trees are grown on reweighted labelled rows (each tree fits the
   residual of the trees before it); every path from a root gives one rule, a
   conjunction of thresholds on statistics.
2. A logistic model with an L1 penalty weighs the rules; most weights become zero.
3. The rules left are compiled into one Spark column expression, so scoring is a
   projection without Python.

The fit runs on the driver over a bounded sample: at most ``MAX_FIT`` labelled rows,
those with the smallest hash of their id. Statistics, scores and everything else
cover all rows and whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrollspark.llm.common import filter_above, private
from enrollspark.llm.textstats import STATS, free_prefix, stat_columns, with_counts

MAX_FIT = 20_000
SEED = 11
TREES = 30
DEPTH = 3
CUTS = 24  # candidate thresholds of a statistic in a node
LEAST_ROWS = 8  # labelled rows on each side of a split
PENALTIES = (0.03, 0.01, 0.003, 0.001)
POINT = 0.3  # the score at which a row is called good

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, greater, threshold), all of them


@dataclass(frozen=True)
class RuleModel:
    names: tuple[str, ...]
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, prefix: str = "") -> Column:
        """The score as a column over statistics named ``prefix`` + name."""
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(rule_column(rule, self.names, prefix), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.intercept + sum((w * holds(r, x) for r, w in self.rules), np.zeros(len(x)))


def rule_column(rule: Rule, names: tuple[str, ...], prefix: str = "") -> Column:
    cond = F.lit(True)
    for j, greater, t in rule:
        c = F.col(prefix + names[j])
        cond = cond & ((c > F.lit(float(t))) if greater else (c <= F.lit(float(t))))
    return cond


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, greater, t in rule:
        out &= (x[:, j] > t) if greater else (x[:, j] <= t)
    return out


def _split(x: np.ndarray, g: np.ndarray, features: np.ndarray) -> tuple[float, int, float] | None:
    best = None
    for j in features:
        v = x[:, j]
        for t in np.unique(np.quantile(v, np.linspace(0.02, 0.98, CUTS), method="lower")):
            left = v <= t
            n = int(left.sum())
            if n < LEAST_ROWS or len(v) - n < LEAST_ROWS:
                continue
            s = g[left].sum()
            gain = s * s / n + (g.sum() - s) ** 2 / (len(v) - n)
            if best is None or gain > best[0]:
                best = (gain, int(j), float(t))
    return best


def _grow(x, g, rows, path: Rule, features, out: list[Rule]) -> None:
    """Grow one tree; ``out`` gets its paths."""
    if path:
        out.append(path)
    found = _split(x[rows], g[rows], features) if len(path) < DEPTH and len(rows) >= 2 * LEAST_ROWS else None
    if found is None or found[0] <= g[rows].sum() ** 2 / max(1, len(rows)) + 1e-9:
        return
    _, j, t = found
    left = x[rows, j] <= t
    _grow(x, g, rows[left], (*path, (j, False, t)), features, out)
    _grow(x, g, rows[~left], (*path, (j, True, t)), features, out)


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> list[Rule]:
    """Paths of boosted trees, each on a half of the rows and statistics; rows of the rarer label weigh as much as the others."""
    rng = np.random.default_rng(SEED)
    f, out = np.zeros(len(y)), []
    heavy = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(trees):
        g = heavy * (y - 1 / (1 + np.exp(-f)))
        rows = rng.permutation(len(y))[: max(4 * LEAST_ROWS, len(y) // 2, 1)]
        features = rng.permutation(x.shape[1])[: max(2, x.shape[1] // 2)]
        paths: list[Rule] = []
        _grow(x, g, rows, (), features, paths)
        out += paths
        leaf = [p for p in paths if not any(q[: len(p)] == p and q != p for q in paths)]
        for p in leaf:
            h = holds(p, x)
            m = h[rows]
            if m.any():
                f[h] += 0.5 * g[rows][m].mean()
    return list(dict.fromkeys(out))


def lasso(z: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, start: np.ndarray, steps: int = 300) -> np.ndarray:
    """Weights (intercept last) of the L1-penalised logistic loss by accelerated proximal gradient."""
    w, v, t = start.copy(), start.copy(), 1.0
    weight = weight / weight.sum()
    v1 = np.ones(z.shape[1] + 1)
    for _ in range(30):  # the largest eigenvalue of the weighted second moments, the intercept's column included
        u = weight * (z @ v1[:-1] + v1[-1])
        v1 = np.append(z.T @ u, u.sum())
        size = float(np.linalg.norm(v1))
        v1 /= max(size, 1e-30)
    step = 4.0 / max(1.1 * size, 1e-9)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ v[:-1] + v[-1], -35, 35)))
        r = weight * (p - y)
        u = v - step * np.append(z.T @ r, r.sum())
        u[:-1] = np.sign(u[:-1]) * np.maximum(np.abs(u[:-1]) - step * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = u + (t - 1) / t2 * (u - w), u, t2
    return w


def cut_for(margin: np.ndarray, y: np.ndarray) -> float:
    """The margin that best parts the labels (mean of both labels' accuracy), halfway to the next value."""
    v = np.unique(margin)
    cuts = (v[1:] + v[:-1]) / 2
    if not len(cuts) or y.min() == y.max():
        return 0.0
    if len(cuts) > 2000:
        cuts = cuts[np.linspace(0, len(cuts) - 1, 2000).astype(int)]
    good, bad = np.sort(margin[y == 1]), np.sort(margin[y == 0])
    worth = 1 - np.searchsorted(good, cuts) / len(good) + np.searchsorted(bad, cuts) / len(bad)
    best = np.flatnonzero(worth >= worth.max() - 1e-9)
    return float(cuts[best[len(best) // 2]])


def fit_rules(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = tuple(STATS), point: float = POINT) -> RuleModel:
    """Fit on labelled statistics; the margin that parts the labels best gets the score ``point``.

    With no rows, or rows of one label only, the model is a constant: that label's
    share (one half with no rows).
    """
    y = np.asarray(y, float)
    if len(y) < 4 * LEAST_ROWS or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return RuleModel(names, float(np.log(share / (1 - share))), ())
    rng = np.random.default_rng(SEED)
    kept = rng.random(len(y)) < 0.25
    if not 0 < y[kept].mean() < 1 or not 0 < y[~kept].mean() < 1:
        kept = np.arange(len(y)) % 4 == 0
    rules = tree_rules(x[~kept], y[~kept])
    z = np.stack([holds(r, x) for r in rules], 1).astype(float)
    some = (z.mean(0) > 0.001) & (z.mean(0) < 0.999)
    rules, z = [r for r, s in zip(rules, some) if s], z[:, some]
    heavy = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    loss = lambda m, q: float(np.sum(heavy[q] * np.log1p(np.exp(-np.clip((2 * y[q] - 1) * m, -35, 35)))))
    w, best = np.zeros(z.shape[1] + 1), None
    for penalty in PENALTIES:
        w = lasso(z[~kept], y[~kept], heavy[~kept], penalty, w)
        got = loss(z[kept] @ w[:-1] + w[-1], kept)
        if best is None or got < 0.99 * best[0]:
            best = (got, penalty)
    w = lasso(z, y, heavy, best[1], np.zeros(z.shape[1] + 1), 600)
    m = z @ w[:-1] + w[-1]
    shift = float(np.log(point / (1 - point))) - cut_for(m, y)
    return RuleModel(names, float(w[-1]) + shift, tuple((r, float(a)) for r, a in zip(rules, w[:-1]) if abs(a) > 1e-6))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int = MAX_FIT) -> DataFrame:
    """At most ``most`` labelled documents: those whose id has the smallest hash; columns doc_id, text, label.

    ``learn`` says over doc_id which rows may be learnt from. An id labelled more
    than once gets its smallest label; null ids and labels are left out. A repeated id
    brings all its rows, which the caller reduces in an order of its own. No labels, or an
    empty table, give an empty sample.
    """
    usable = labels.filter(learn & F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    # about twice as many as wanted pass the threshold, so that the sort sees a bounded number of rows
    share = min(1.0, 2.0 * most / max(1, usable.count()))
    h = F.xxhash64(F.col("doc_id"), F.lit(SEED))
    picked = usable.filter(h <= F.lit(min((1 << 63) - 1, int((share - 0.5) * (1 << 64))))).orderBy(h, "doc_id").limit(most)
    # at most ``most`` pairs of an id and a label
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def learn_quality(docs: DataFrame, labels: DataFrame, learn: Column, most: int = MAX_FIT) -> RuleModel:
    """The model of a bounded sample of labelled documents (``labelled_sample``).

    Null and empty texts have zero statistics. Of rows with one id the one with the
    least statistics, in their order, counts, so the model is the same in every run. Without any
    labelled document, or with one label only, the score is a constant. Other columns
    of either table are not looked at, whatever their names.
    """
    sample = labelled_sample(docs, labels, "quality", learn, most)
    p = free_prefix(sample)
    rows = with_counts(sample, p).select("doc_id", "label", *(c.alias(s) for s, c in zip(STATS, stat_columns(p))))
    least = F.min(F.struct("label", *STATS)).alias("r")
    rows = rows.groupBy("doc_id").agg(least).select("doc_id", "r.*").collect()  # at most ``most``
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([[r[s] for s in STATS] for r in rows], float).reshape(len(rows), len(STATS))
    return fit_rules(x, np.array([r["label"] for r in rows], float))


def score_quality(docs: DataFrame, model: RuleModel, score: str = "score", text: str = "text") -> DataFrame:
    """Add column ``score`` (0 to 1, higher: better) from the whole text.

    A null text counts as empty; an empty text gets the score of its zero
    statistics. Repeated rows score alike; other columns stay as they are.
    """
    p = free_prefix(docs)
    d = with_counts(docs, p, text)
    stats = [c.alias(f"{p}x_{n}") for n, c in zip(STATS, stat_columns(p))]
    d = d.select(*[F.col(f"`{c}`") for c in docs.columns], *stats)
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], model.score(f"{p}x_").alias(score))


def filter_quality(docs: DataFrame, model: RuleModel, point: float = POINT, text: str = "text") -> DataFrame:
    """The rows whose score is at least ``point``, with their own columns only."""
    (s,) = private(docs, "score")
    return filter_above(score_quality(docs, model, s, text), F.col(s) >= point).drop(s)
