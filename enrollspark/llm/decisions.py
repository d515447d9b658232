"""Quality rules: decision lists learnt by sequential covering, applied as Spark conditional expressions.

A rule is a conjunction of thresholds on text statistics. Each is grown on two
thirds of the labelled rows that no earlier rule covers, one threshold after the
other by information gain, then pruned on the last third: the shortest prefix
with the best precision stays. Learning stops at the first rule that isn't
precise enough. Everything is DataFrame work: a growing step is one aggregation,
after which the driver sees one count for each statistic and threshold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrollspark.llm.common import stage
from enrollspark.llm.textstats import COUNTS, STATS, free_prefix, stat_columns, with_counts

CUTS = 24  # thresholds tried for a statistic: quantiles of the labelled rows
MOST_RULES = 12
MOST_TESTS = 3  # thresholds in a rule
LEAST_COVER = 5  # labelled bad rows a rule must cover
PRECISION = 0.9  # of a rule, on the rows it wasn't grown on
SEED = 29

# the fixed rules that come first
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words

Test = tuple[int, bool, float]  # (statistic, greater, threshold)


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; a row that meets one is dropped, any other is kept."""

    names: tuple[str, ...]
    rules: tuple[tuple[Test, ...], ...]

    def kept(self, prefix: str = "") -> Column:
        out = None
        for rule in self.rules:
            cond = _all(rule, self.names, prefix)
            out = F.when(cond, F.lit(False)) if out is None else out.when(cond, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))


def _test(t: Test, names, prefix: str = "") -> Column:
    c, cut = F.col(prefix + names[t[0]]), F.lit(float(t[2]))
    return c > cut if t[1] else c <= cut


def _all(tests, names, prefix: str = "") -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & _test(t, names, prefix)
    return out


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    """Bits that a rule covering p bad and n good rows gains over one that covers p0 and n0."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learn_list(rows: DataFrame, label: str, names: list[str] | None = None) -> DecisionList:
    """Learn from labelled statistics: column ``label`` (1 good, 0 bad) and a double column for each of ``names``.

    Rows with a null label or statistic are left out. With no rows, or rows of
    one label only, the list is empty and keeps everything.
    """
    names = list(names or STATS)
    d = rows.select(F.col(label).cast("int").alias("good"), *[F.col(n).cast("double").alias(n) for n in names]).dropna()
    d = d.withColumn("grow", F.pmod(F.xxhash64(F.lit(SEED), *names), F.lit(3)) != 0)
    d = stage(d, "labelled")
    at = [k / CUTS for k in range(1, CUTS)]
    row = d.agg(*[F.percentile_approx(n, at, 10_000).alias(n) for n in names]).first()
    cuts = {n: sorted({float(v) for v in row[n] or []}) for n in names}
    bins = F.array(*[sum(((F.col(n) > F.lit(c)).cast("int") for c in cuts[n]), F.lit(0)) for n in names])

    def count(df: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
        """Bad and good rows by statistic and bin."""
        e = df.select("good", F.posexplode(bins).alias("stat", "bin"))
        c = e.groupBy("stat", "bin").agg(F.sum(1 - F.col("good")).alias("p"), F.sum("good").alias("n"))
        return {(r["stat"], r["bin"]): (r["p"], r["n"]) for r in c.collect()}  # one row for each threshold at most

    rules: list[tuple[Test, ...]] = []
    left = d
    while len(rules) < MOST_RULES:
        tests: list[Test] = []
        part = left.filter("grow")
        while len(tests) < MOST_TESTS:
            by = count(part)
            p0, n0 = (sum(v[k] for (s, _), v in by.items() if s == 0) for k in (0, 1))
            if p0 < LEAST_COVER or n0 == 0:
                break
            best = (0.0, None)
            for s, name in enumerate(names):
                p = n = 0
                for b, cut in enumerate(cuts[name]):
                    q = by.get((s, b), (0, 0))
                    p, n = p + q[0], n + q[1]
                    for t, (a, z) in (((s, False, cut), (p, n)), ((s, True, cut), (p0 - p, n0 - n))):
                        if a >= LEAST_COVER and (g := _gain(a, z, p0, n0)) > best[0] + 1e-9:
                            best = (g, t)
            if best[1] is None:
                break
            tests.append(best[1])
            part = part.filter(_test(best[1], names))
        if not tests:
            break
        seen = left.filter(~F.col("grow")).agg(
            *[F.sum(F.when(_all(tests[: k + 1], names), w).otherwise(0)).alias(f"{a}{k}") for k in range(len(tests)) for a, w in (("p", 1 - F.col("good")), ("n", F.col("good")))]
        )
        r = seen.first()
        worth = [((r[f"p{k}"] or 0) + 0.5) / ((r[f"p{k}"] or 0) + (r[f"n{k}"] or 0) + 1.0) for k in range(len(tests))]
        k = max(range(len(tests)), key=lambda i: (round(worth[i], 3), -i))
        p, n = r[f"p{k}"] or 0, r[f"n{k}"] or 0
        if p == 0 or p / (p + n) < PRECISION:
            break
        rules.append(tuple(tests[: k + 1]))
        left = left.filter(~_all(rules[-1], names))
    return DecisionList(tuple(names), tuple(rules))


def with_statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """Add counts and statistics of the whole text (null: none); their columns begin with the prefix returned."""
    p = free_prefix(docs)
    d = with_counts(docs, p, text)
    return d.select("*", *[c.alias(p + n) for n, c in zip(STATS, stat_columns(p))]), p


def base_failed(prefix: str) -> Column:
    words, again = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < LEAST_WORDS) | (100 * again > MOST_REPEATED * words)


def label_statistics(stats: DataFrame, prefix: str, labels: DataFrame, learn: Column, label: str = "quality") -> DataFrame:
    """The labelled rows' statistics under their plain names; an id labelled more than once gets its smallest label."""
    y = labels.filter(learn & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("good"))
    return stats.select("doc_id", *[F.col(prefix + n).alias(n) for n in STATS]).join(y, "doc_id").select("good", *STATS)


def judge(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every document.

    An empty or null text has no words and fails the base; repeated rows are
    judged alike; an empty table gives an empty result. Statistics are made once
    and staged, as both the learning and the verdict read them.
    """
    stats, p = with_statistics(docs.select("doc_id", "text"))
    stats = stage(stats.drop("text"), "statistics")
    rules = learn_list(label_statistics(stats, p, labels, learn), "good")
    failed = base_failed(p)
    counts = [F.col(p + n).alias(n) for n in COUNTS[:5]]
    return stats.select("doc_id", *counts, failed.alias("base_failed"), F.when(failed, F.lit(False)).otherwise(rules.kept(p)).alias("kept"))
