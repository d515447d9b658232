"""Vector code compression: the nearest codebook entry by Orchard's search.

Every codebook entry has the list of all entries by their distance from it. A search
starts at some entry and goes along its list. At an entry that is nearer, it jumps to
that entry's list; it marks entries that it has seen, and ends where the list is beyond
twice the current distance, as nothing there can be nearer. All distances are squared
integers, so ends and ties are exact.

Codebooks are refined in rounds: each task sums up the vectors of each entry, Spark adds
the sums, and the driver gets one mean for each entry and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrollspark.llm.balltree import HIGHEST, integer_vector
from enrollspark.llm.common import stage

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
STEP = 16  # places of a list that are looked at together
ROWS = 2048  # vectors that are searched together

OUT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def exact_type(most: int, length: int):
    """An array type in which squared distances of components up to ``most``, and four times these, are exact."""
    worst = 16 * max(1, length) * max(1, most) ** 2
    return np.float64 if worst < 1 << 53 else np.int64 if worst < 1 << 63 else object


def largest(x: np.ndarray) -> int:
    return int(np.abs(x.astype(object)).max()) if x.size else 0


class Orchard:
    """A codebook (entry x component) with each entry's list of neighbours; ``compared`` counts the distances that searches compute."""

    def __init__(self, book: np.ndarray) -> None:
        self.book = book
        apart = np.stack([((book - e) ** 2).sum(1) for e in book])
        self.lists = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.lists, 1)
        self.level = np.argsort(book.sum(1), kind="stable")  # entries by the sum of their components, for a first guess
        self.compared = 0

    def guess(self, x: np.ndarray) -> np.ndarray:
        """An entry whose components add up to nearly the vector's sum."""
        sums = self.book.sum(1)[self.level]
        at = np.searchsorted(sums.astype(float), x.sum(1).astype(float)).clip(0, len(sums) - 1)
        return self.level[at]

    def distance(self, x: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Of each vector and its entries (a row each)."""
        self.compared += entries.size
        gap = x[:, None, :] - self.book[entries]
        return (gap * gap).sum(2)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each vector's nearest entry, ties to the lower index."""
        n, m = len(x), len(self.book)
        at = self.guess(x)
        best = self.distance(x, at[:, None])[:, 0]
        seen = np.zeros((n, m), bool)
        seen[np.arange(n), at] = True
        place = np.zeros(n, np.int64)
        live = np.arange(n)
        while len(live):
            # the next places of the list within twice the current distance that aren't marked
            p = place[live, None] + np.arange(STEP)
            inside = p < m
            p = p.clip(0, m - 1)
            inside &= self.apart[at[live, None], p] <= 4 * best[live, None]
            near = self.lists[at[live, None], p]
            fresh = inside & ~seen[live[:, None], near]
            place[live] += STEP
            some = fresh.any(1)
            rows, j, new = live[some], near[some], fresh[some]
            if len(rows):
                d = self.distance(x[rows], j)
                k, slot = np.nonzero(new)
                seen[rows[k], j[k, slot]] = True
                # the nearest of them, the lower index of equals
                d = np.where(new, d, best[rows, None] + 1)
                least = d.min(1)
                entry = np.where(d == least[:, None], j, m).min(1)
                jump = (least < best[rows]) | ((least == best[rows]) & (entry < at[rows]))
                rows = rows[jump]
                at[rows], best[rows], place[rows] = entry[jump], least[jump], 0
                moved = np.zeros(n, bool)
                moved[rows] = True
                inside |= moved[live, None]
            # the list is sorted: past its end, or twice the distance, nothing is left
            live = live[inside[:, -1]]
        return at, best


def part_bounds(length: int, parts: int = PARTS) -> list[tuple[int, int]]:
    cuts = [length * k // parts for k in range(parts + 1)]
    return list(zip(cuts, cuts[1:]))


def search(x: np.ndarray, books: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(entry, squared distance) of all vectors, for each part in turn."""
    for (a, b), book in zip(part_bounds(x.shape[1], len(books)), books):
        kind = exact_type(max(largest(x[:, a:b]), largest(book)), b - a)
        made = Orchard(book.astype(kind))
        own = x[:, a:b].astype(kind)
        found = [made.nearest(own[k : k + ROWS]) for k in range(0, len(own), ROWS)]
        yield np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _arrays(parts: Iterator[pd.DataFrame], length: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for part in parts:
        if len(part):
            yield part, np.array(part["vec"].tolist(), np.int64).reshape(len(part), length)


def _sums(books: list[np.ndarray], length: int):
    """Counts and sums of each entry's parts over a whole task."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, object) for b in books]
        for _, x in _arrays(parts, length):
            wide = largest(x) * len(x) >= 1 << 62
            for p, ((a, b), (entry, _)) in enumerate(zip(part_bounds(length, len(books)), search(x, books))):
                counts[p] += np.bincount(entry, minlength=len(books[p]))
                add = np.zeros(books[p].shape, object if wide else np.int64)
                np.add.at(add, entry, x[:, a:b].astype(add.dtype))
                totals[p] += add.astype(object)
        for p, (count, total) in enumerate(zip(counts, totals)):
            used, at = np.nonzero(np.repeat(count[:, None] > 0, total.shape[1], 1))
            yield pd.DataFrame({"part": p, "entry": used, "at": at, "n": count[used], "total": [Decimal(int(v)) for v in total[used, at]]})

    return run


def _codes(books: list[np.ndarray], length: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, x in _arrays(parts, length):
            found = list(search(x, books))
            code = ["".join(f"{e:02x}" for e in row) for row in np.stack([e for e, _ in found], 1).tolist()]
            error = [min(HIGHEST, sum(map(int, row))) for row in zip(*(d.tolist() for _, d in found))]
            yield pd.DataFrame({"vec_id": part["vec_id"].astype("Int64"), "label": part["label"].astype("Int64"), "code": code, "error": error})

    return run


def learn_books(vectors: DataFrame, first: list[list[int]], rounds: int = ROUNDS, parts: int = PARTS) -> list[np.ndarray]:
    """The codebooks, entry x component for each part, after ``rounds`` of assigning all ``vectors`` (column vec) and taking means; entries that get none stay."""
    length = len(first[0])
    start = np.array(first, np.int64).reshape(len(first), length)
    books = [start[:, a:b] for a, b in part_bounds(length, parts)]
    for _ in range(rounds):
        sums = vectors.mapInPandas(_sums(books, length), "part int, entry int, at int, n long, total decimal(38,0)")
        sums = sums.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        books = [b.copy() for b in books]
        for r in sums.collect():  # one row for each entry and component of the codebooks
            books[r["part"]][r["entry"], r["at"]] = int(r["total"]) // r["n"]
    return books


def book_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def compress(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that is kept.

    Rows whose vector is null or holds null or non-finite components go, and rows whose
    vector has another length than that of the smallest vec_id. Components beyond a
    long end at its limit, and so do errors. A length that isn't divisible by four
    has shorter parts first. Null ids come after all others; repeated rows count as often
    as they come, in the codebooks too; of rows with equal ids the smaller vector comes
    first. Null labels are one label. An empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    v = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), integer_vector(F.col("embedding"), scale).alias("vec"))
    v = stage(v.filter("vec IS NOT NULL"), "vectors")
    order = [F.col("vec_id").asc_nulls_last(), F.col("vec")]
    least = v.orderBy(*order).limit(1).collect()
    if not least:
        return spark.createDataFrame([], OUT)
    length = len(least[0]["vec"])
    v = v.filter(F.size("vec") == length)
    first = [r["vec"] for r in v.orderBy(*order).limit(ENTRIES).collect()]  # the codebooks' first entries
    books = learn_books(v, first)
    coded = stage(v.mapInPandas(_codes(books, length), "vec_id long, label long, code string, error long"), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(HIGHEST).cast("decimal(38,0)")).cast("long")
    labels = coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    out = coded.join(labels, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(book_digest(books)).alias("codebooks_sha256"))


def _round_sql(k: int) -> str:
    """One round: every part's nearest entry, then the means."""
    return f"""
a{k} AS MATERIALIZED (
  SELECT i, part, x, arg_min(entry, (d, entry)) AS entry, CAST(min(d) AS BIGINT) AS d
  FROM (SELECT p.i, p.part, p.x, b.entry, list_sum([y * y FOR y IN [p.x[n] - b.x[n] FOR n IN range(1, len(p.x) + 1)]]) AS d
    FROM p JOIN b{k} AS b USING (part))
  GROUP BY i, part, x
), m{k} AS (
  SELECT part, entry, k, sum(v) AS s, count(*) AS n
  FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS k FROM a{k}) GROUP BY ALL
), l{k} AS (
  SELECT part, entry, list(CAST((s - (((s % n) + n) % n)) // n AS BIGINT) ORDER BY k) AS x FROM m{k} GROUP BY ALL
), b{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(l.x, b.x) AS x FROM b{k} AS b LEFT JOIN l{k} AS l USING (part, entry)
)"""


ORACLE = f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS i, vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings WHERE embedding IS NOT NULL AND NOT list_contains([coalesce(isfinite(x), false) FOR x IN embedding], false)
), p AS MATERIALIZED (
  SELECT i, part, e[part * len(e) // 4 + 1 : (part + 1) * len(e) // 4] AS x FROM v, range(4) AS r(part)
), b0 AS MATERIALIZED (SELECT part, i AS entry, x FROM p WHERE i < 256),
{",".join(_round_sql(k) for k in range(ROUNDS + 1))},
h AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS}
), c AS (
  SELECT i, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY i
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN c USING (i), h
"""
