"""Best-fit packing by a grouping genetic algorithm.

Documents become pieces of at most LIMIT tokens. Pieces are dealt to cells of bounded size,
and every cell is packed by several islands, each a Spark group of its own: a
population of packings whose genes are whole sequences. Crossover injects well-filled
sequences of one parent into the other, removes the sequences there that hold one of
their pieces, and puts the displaced pieces where they fit best. After every round an
island's best packing migrates to the other islands of its cell; the best island's
packing stands at the end. Where the rows' order counts (``pack_stream``), cells are
contiguous ranges of it and sequences are numbered along it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from enrollspark.llm.common import deal, stage
from enrollspark.llm.tokens import encoder

LIMIT = 2048
END = 0  # the id that ends a document
CELL = 8192  # pieces of a cell, about
ISLANDS = 2
ROUNDS = 2
POPULATION = 4
GENERATIONS = 6  # at least, and as many as packing WORK pieces takes
WORK = 30_000
SEED = 5
TRADED, TRIED = 24, 64  # pieces that are offered for an exchange, sequences that are offered them

ROWS = 1024  # rows of a file that are numbered together

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut(n: int, limit: int = LIMIT) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole ones, but the first takes what is left over."""
    first = n % limit or limit
    return [(0, min(n, first)), *((s, limit) for s in range(first, n, limit))]


def _pieces(path: str | None, limit: int, keep: tuple[str, ...] = ()):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = encoder(path or vocabulary())
        for part in parts:
            rows, came = [], []
            for at, (doc, text) in enumerate(zip(part["doc_id"], part["text"])):
                ids = np.append(made.ids(text or ""), np.uint32(END)).astype("<u4")
                for k, (s, n) in enumerate(cut(len(ids), limit)):
                    rows.append((doc, k, s, n, zlib.crc32(ids[s : s + n].tobytes())))
                    came.append(at)
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out.assign(**{c: part[c].to_numpy()[np.array(came, int)] for c in keep})

    return run


def token_pieces(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document (null text: empty, so its end alone).

    Repeated rows and null ids give their pieces as often as they come; a text of any length is cut whole;
    other columns are left behind, whatever their names; an empty table gives an empty result.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(_pieces(path, limit), PIECES)


def stream_pieces(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """The pieces with ``number``, their gapless place from 0 along the stream that the files of ``docs`` are.

    The stream is the files by part number and name, each in row order; ``docs`` must
    be a table read from Parquet files. Pieces are numbered in ranges of ROWS rows of a
    file, which start after the ranges before.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    made = stage(d.mapInPandas(_pieces(path, limit, ("file", "row")), f"{PIECES}, file string, row long"), "stream")
    made = made.withColumn("range", F.floor(F.col("row") / ROWS))
    part = F.regexp_extract(F.element_at(F.split("file", "/"), -1), r"^part-(\d+)", 1).try_cast("long")
    before = Window.orderBy(part, "file", "range").rowsBetween(Window.unboundedPreceding, -1)  # over ranges, not rows
    starts = made.groupBy("file", "range").agg(F.count(F.lit(1)).alias("n")).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    own = Window.partitionBy("file", "range").orderBy("row", "piece")
    numbered = made.withColumn("at", F.row_number().over(own) - 1).join(starts.drop("n"), ["file", "range"])
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("at")).alias("number"))


class Packing:
    """A packing of pieces 0..n-1: its sequences, and what is free in each."""

    def __init__(self, lengths: list[int], limit: int, bins: list[list[int]] | None = None) -> None:
        self.lengths, self.limit = lengths, limit
        self.bins = bins or []
        self.free = [limit - sum(lengths[i] for i in b) for b in self.bins]

    def best_fit(self, pieces: list[int]) -> Packing:
        """Put pieces, the longest first, each into the fullest sequence that takes it, or a new one."""
        room = sorted((f, k) for k, f in enumerate(self.free) if f)
        for i in sorted(pieces, key=lambda i: -self.lengths[i]):
            n = self.lengths[i]
            at = bisect_left(room, (n, -1))
            if at < len(room):
                f, k = room.pop(at)
            else:
                f, k = self.limit, len(self.bins)
                self.bins.append([])
                self.free.append(self.limit)
            self.bins[k].append(i)
            self.free[k] = f - n
            if f > n:
                insort(room, (f - n, k))
        return self

    def fitness(self) -> tuple[int, float]:
        """Fewer sequences are better; then uneven filling, which leaves room in one place."""
        return -len(self.bins), sum(((self.limit - f) / self.limit) ** 2 for f in self.free)


def crossover(a: Packing, b: Packing, rng: np.random.Generator) -> Packing:
    """Some of b's best-filled sequences, whole, then a's that share no piece with them, then the displaced pieces by best fit."""
    order = sorted(range(len(b.bins)), key=lambda k: b.free[k])
    order = order[: max(1, int(len(order) * rng.uniform(0.2, 0.6)))]
    given = [b.bins[k] for k in order]
    taken = {i for g in given for i in g}
    kept, displaced = [], []
    for g in a.bins:
        if taken.isdisjoint(g):
            kept.append(g)
        else:
            displaced += [i for i in g if i not in taken]
    child = Packing(a.lengths, a.limit, [list(g) for g in given + kept])
    return child.best_fit(exchange(child.bins, child.free, displaced, a.lengths))


def exchange(bins: list[list[int]], free: list[int], displaced: list[int], lengths: list[int]) -> list[int]:
    """Before displaced pieces go back: exchange one to three pieces of a sequence for one to three displaced ones that fill it better.

    The sequences with most room change in place, each at most once in a call; gives the pieces that are displaced then. An
    exchange makes the displaced pieces shorter in sum, and short pieces fit where long ones don't. At most
    TRADED displaced pieces, spread over all lengths, are offered; the others stay displaced.
    """
    by_length = sorted(displaced, key=lambda i: lengths[i])
    offered = {int(k) for k in np.linspace(0, len(by_length) - 1, min(TRADED, len(by_length)))}
    loose, rest = [i for k, i in enumerate(by_length) if k in offered], [i for k, i in enumerate(by_length) if k not in offered]
    tried = [k for k in sorted(range(len(bins)), key=lambda k: -free[k])[:TRIED] if free[k] and len(bins[k]) <= TRADED]
    sums: dict[int, tuple[int, ...]] = {}
    for k in tried:
        if not sums:
            for n in (1, 2, 3):
                for c in combinations(loose, n):
                    sums.setdefault(sum(lengths[i] for i in c), c)
            order = sorted(sums)
        best: tuple = (0, (), ())
        for n in (1, 2, 3):
            for out in combinations(bins[k], n):
                room = sum(lengths[i] for i in out)
                at = bisect_right(order, room + free[k])
                if at and order[at - 1] - room > best[0]:
                    best = (order[at - 1] - room, out, sums[order[at - 1]])
        gain, out, into = best
        if gain:
            bins[k] = [i for i in bins[k] if i not in out] + list(into)
            free[k] -= gain
            loose = [i for i in loose if i not in into] + list(out)
            sums = {}
    return loose + rest


def mutate(a: Packing, rng: np.random.Generator) -> Packing:
    """Empty the worst-filled sequences and a few others, and place their pieces anew."""
    order = sorted(range(len(a.bins)), key=lambda k: -a.free[k])
    gone = set(order[: 1 + len(order) // 50]) | set(rng.integers(0, len(order), 1 + len(order) // 50).tolist())
    loose = [i for k in gone for i in a.bins[k]]
    child = Packing(a.lengths, a.limit, [list(g) for k, g in enumerate(a.bins) if k not in gone])
    return child.best_fit(exchange(child.bins, child.free, loose, a.lengths))


def evolve(lengths: list[int], limit: int, elites: list[list[list[int]]], rng: np.random.Generator, generations: int = GENERATIONS) -> Packing:
    """The best packing after some generations; ends at once where no packing can have fewer sequences."""
    n = len(lengths)
    people = [Packing(lengths, limit, [list(g) for g in e]) for e in elites]
    if not people:
        people.append(Packing(lengths, limit).best_fit(list(range(n))))
    least = -(-sum(lengths) // limit)
    best = max(people, key=Packing.fitness)
    if len(best.bins) <= least:
        return best
    while len(people) < POPULATION:
        # a part of the pieces in random order first, so that packings differ
        some = rng.permutation(n)[: n // 4].tolist()
        p = Packing(lengths, limit)
        for k in range(0, len(some), 256):
            p.best_fit(some[k : k + 256])
        rest = set(some)
        people.append(p.best_fit([i for i in range(n) if i not in rest]))
    for _ in range(max(generations, WORK // max(1, n))):
        people.sort(key=Packing.fitness, reverse=True)
        if len(people[0].bins) <= least:
            break
        a, b = people[0], people[1 + int(rng.integers(0, len(people) - 1))]
        children = [crossover(a, b, rng), crossover(b, a, rng), mutate(a, rng)]
        people = sorted([*people, *children], key=Packing.fitness, reverse=True)[:POPULATION]
    return max(people, key=Packing.fitness)


def _ordered(part: pd.DataFrame) -> pd.DataFrame:
    """A cell's pieces in an order that every island and round agrees on: the stream's, if they have one; rows equal in all columns may change places."""
    if "number" in part:
        return part.sort_values("number").reset_index(drop=True)
    return part.sort_values(["doc_id", "piece", "start", "length", "ids_crc32"], na_position="first", kind="stable").reset_index(drop=True)


def _island(limit: int, generations: int):
    def run(key: tuple, pieces: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        cell, island, at = (int(v) for v in key)
        lengths = _ordered(pieces)["length"].astype(int).tolist()
        came = []
        for _, e in elites.groupby("source", sort=True):
            bins: dict[int, list[int]] = {}
            for p, b in zip(e["place"].tolist(), e["bin"].tolist()):
                bins.setdefault(b, []).append(p)
            came.append([bins[b] for b in sorted(bins)])
        best = evolve(lengths, limit, came, np.random.default_rng([SEED, cell, island, at]), generations)
        rows = [(i, k) for k, g in enumerate(best.bins) for i in g]
        out = pd.DataFrame(rows, columns=["place", "bin"], dtype=np.int64)
        return out.assign(cell=cell, island=island, bins=len(best.bins))[["cell", "island", "place", "bin", "bins"]]

    return run


def _along(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bins numbered by the place of their longest piece, the first of several; a place by piece."""
    order = np.lexsort((np.arange(len(bins)), -lengths, bins))
    _, first, at = np.unique(bins[order], return_index=True, return_inverse=True)
    out = np.empty(len(bins), np.int64)
    out[order] = np.argsort(np.argsort(order[first]))[at]
    return out


def _placed(key: tuple, pieces: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
    out = _ordered(pieces)
    bins = best.sort_values("place")["bin"].to_numpy(np.int64)
    if "number" in out:
        bins = _along(bins, out["length"].to_numpy())
    out["sequence_id"] = (int(key[0]) << 32) + bins
    out["offset"] = out.groupby("sequence_id")["length"].cumsum() - out["length"]
    return out[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]


def pack_pieces(pieces: DataFrame, limit: int = LIMIT, islands: int = ISLANDS, rounds: int = ROUNDS, generations: int = GENERATIONS) -> DataFrame:
    """Add sequence_id and offset: every piece once, in sequences of at most ``limit``, gapless from 0.

    The number of cells follows the number of pieces, whose hash deals them out, and rows
    that are equal are dealt on by file and row, so
    no document, source or group of copies makes a cell large. Pieces with a ``number``
    (gapless from 0) are dealt by it: a cell is the next CELL pieces, and sequence_id
    rises with the number of a sequence's longest piece. Repeated rows are packed
    as often as they come; an empty table gives an empty result.
    """
    pieces = stage(pieces, "pieces")
    if "number" in pieces.columns:
        p = pieces.withColumn("cell", F.floor(F.col("number") / CELL).cast("int"))
    else:
        p = deal(pieces, [F.col(c) for c in ("doc_id", "piece", "ids_crc32")], CELL, "cell").withColumn("cell", F.col("cell").cast("int"))
        p = stage(p, "cells")  # a row keeps its cell however often it is read
    every = F.array(*map(F.lit, range(islands)))
    came = pieces.sparkSession.range(0).selectExpr("0 AS cell", "0 AS island", "0 AS source", "id AS place", "id AS bin")
    for at in range(rounds):
        mine = p.withColumn("island", F.explode(every)).withColumn("at", F.lit(at))
        groups = mine.groupBy("cell", "island", "at").cogroup(came.withColumn("at", F.lit(at)).groupBy("cell", "island", "at"))
        elites = stage(groups.applyInPandas(_island(limit, generations), "cell int, island int, place long, bin long, bins int"), "elites")
        # every island meets the best packing of each
        came = elites.select("cell", F.explode(every).alias("island"), F.col("island").alias("source"), "place", "bin")
    sizes = elites.groupBy("cell", "island").agg(F.first("bins").alias("bins"))
    best = sizes.groupBy("cell").agg(F.min_by("island", F.struct("bins", "island")).alias("island"))
    won = elites.join(best, ["cell", "island"]).select("cell", "place", "bin")
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return p.groupBy("cell").cogroup(won.groupBy("cell")).applyInPandas(_placed, out)


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Pieces of every document and where they stand; a repeated document is packed as often as it comes."""
    return pack_pieces(token_pieces(docs, path))


def pack_stream(docs: DataFrame, path: str | None = None) -> DataFrame:
    """As ``pack_documents``, in the order of the rows in their files, which the sequences follow cell by cell.

    ``docs`` is read from Parquet files. Null and empty texts are one piece, their end; repeated rows are
    packed as often as they come; an empty table gives an empty result.
    """
    return pack_pieces(stream_pieces(docs, path))
