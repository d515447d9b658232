"""Near-duplicate vectors by tiled comparison of principal components.

Unit vectors are turned so that their leading components hold most of what they differ
in. Two vectors' cosine is the product of the leading components plus that of the rest,
which is at most the product of the rests' norms. Tiles of vectors are compared on few
leading components; pairs whose bound can't reach the threshold stop there, others go on
to more components, and what is left is computed on the vectors as they came.

Vectors are dealt to cells by medians of the leading components, and cells to tiles of
bounded size. Two cells whose boxes can't hold a link are not compared at all. A task holds
several tiles, so that there are few tasks that a vector visits: of two tasks with tiles that
meet, the one's vectors go to the other once. Equal vectors are one before any of this,
and a task gives a vector's number of links and one link to follow, never all its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrollspark.llm.common import row_salt, stage
from enrollspark.llm.components import components
from enrollspark.llm.shards import visit_shards

THRESHOLD = 0.9
TILE = 4096  # vectors that are compared as one
TASKS = 12  # while none of them holds more than HELD vectors, no more tasks than these
HELD = 65_536  # vectors that a task holds, but a tile at least
CELLS = 1024  # most cells; a cell with more than TILE vectors is dealt to parts
FIT = 8192  # most vectors that the axes and medians are fitted on; every vector is compared whatever they are
LEADING = (16, 32)  # components after which the bound is looked at
CHUNK = 1024  # visitors that are compared together
PAIRS = 65_536  # pairs whose further components are multiplied together
SLACK = 1e-4  # leading products are taken in single precision


def scaled_vector(embedding: Column) -> Column:
    """The vector in doubles, times a power of two that brings its largest component to 1 or 2, so that no norm over- or underflows; null if it is null, zero, or holds null or non-finite components."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    most = F.array_max(F.transform(F.when(~bad, x), lambda v: F.abs(v)))
    # in two steps, as the power itself may be beyond a double; the zeros of either sign are one
    half = F.transform(F.array(most), lambda m: F.when(m > 0, F.pow(F.lit(2.0), F.floor(-F.log2(m) / 2))))
    return F.transform(half, lambda h: F.when(h.isNotNull(), F.transform(x, lambda v: v * h * h + F.lit(0.0))))[0]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def principal_axes(x: np.ndarray) -> np.ndarray:
    """Orthogonal axes as columns, the one with most of the vectors' energy first."""
    u = unit(x)
    return np.linalg.eigh(u.T @ u)[1][:, ::-1]


def median_splits(lead: np.ndarray, depth: int) -> list[np.ndarray]:
    """The thresholds of ``depth`` levels: level k halves each of its 2^k cells on component k."""
    at, out = np.zeros(len(lead), np.int64), []
    for k in range(depth):
        level = np.zeros(1 << k)
        for c in range(1 << k):
            own = lead[at == c, k]
            level[c] = np.median(own) if len(own) else 0.0
        out.append(level)
        at = 2 * at + (lead[:, k] > level[at])
    return out


def cell_of(lead: np.ndarray, splits: list[np.ndarray]) -> np.ndarray:
    at = np.zeros(len(lead), np.int64)
    for k, level in enumerate(splits):
        at = 2 * at + (lead[:, k] > level[at])
    return at


class Axes:
    """What is fitted for the vectors of one length: axes and the medians that part cells."""

    def __init__(self, sample: np.ndarray, cells: int) -> None:
        self.axes = principal_axes(sample)
        self.depth = min(sample.shape[1], max(0, int(cells - 1).bit_length()))
        self.splits = median_splits(self.turn(sample), self.depth)

    def turn(self, x: np.ndarray) -> np.ndarray:
        return unit(x) @ self.axes


def suffix_norms(turned: np.ndarray, k: int) -> np.ndarray:
    return np.sqrt((turned[:, k:] ** 2).sum(1))


def _places(axes: dict[int, Axes], lead: int):
    """Cell, leading components and the rest's norm of each vector."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for n, some in part.groupby(part["vec"].map(len)):
                turned = axes[n].turn(np.array(some["vec"].tolist(), float).reshape(len(some), n))
                yield some.assign(length=n, cell=cell_of(turned, axes[n].splits), lead=list(turned[:, :lead]), rest=suffix_norms(turned, lead))

    return run


def meeting_cells(boxes: pd.DataFrame, threshold: float) -> list[tuple[int, int]]:
    """Pairs of places in ``boxes`` (length, low, high, rest) whose vectors can have a cosine of ``threshold``, each both ways."""
    out = []
    low, high = (np.array(boxes[c].tolist(), float).reshape(len(boxes), -1) for c in ("low", "high"))
    for i in range(len(boxes)):
        same = (boxes["length"] == boxes["length"].iloc[i]).to_numpy()
        corners = [a[i] * b for a in (low, high) for b in (low, high)]
        most = np.maximum.reduce(corners).sum(1) + boxes["rest"].iloc[i] * boxes["rest"].to_numpy()
        out += [(i, int(j)) for j in np.flatnonzero(same & (most >= threshold - SLACK))]
    return out


class Tile:
    """A tile's vectors; ``counts`` tells how many pairs each step looked at."""

    def __init__(self, rows: pd.DataFrame, axes: dict[int, Axes], threshold: float) -> None:
        self.node, self.copies = rows["node"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64)
        n = len(rows["vec"].iloc[0])
        self.axes, self.threshold = axes[n], threshold
        self.stops = [k for k in LEADING if k < n]
        self.own = self.made(rows)
        self.links = np.zeros(len(rows), np.int64)
        self.root = np.arange(len(rows))
        self.counts = np.zeros(len(self.stops) + 2, np.int64)

    def made(self, rows: pd.DataFrame):
        x = np.array(rows["vec"].tolist(), float)
        turned = self.axes.turn(x)
        return x, np.sqrt((x * x).sum(1)), turned, turned[:, : LEADING[0]].astype(np.float32), [suffix_norms(turned, k) for k in self.stops]

    def pairs(self, other, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(visitor, own) of all links; with ``skip`` only to own places beyond those."""
        x, norm, turned, lead, rests = self.own
        vx, vnorm, vturned, vlead, vrests = other
        most = vlead @ lead.T
        if self.stops:
            most += vrests[0].astype(np.float32)[:, None] * rests[0].astype(np.float32)
        near = most >= self.threshold - SLACK
        if skip is not None:
            near &= np.arange(len(x)) > skip[:, None]
        self.counts[0] += near.size
        i, j = np.nonzero(near)
        self.counts[1] += len(i)
        out_i, out_j = [], []
        for at in range(0, len(i), PAIRS):
            a, b = i[at : at + PAIRS], j[at : at + PAIRS]
            done = np.zeros(len(a))
            for step, k in enumerate(self.stops[1:], 1):
                first = self.stops[step - 1] if step > 1 else 0
                done += (vturned[a, first:k] * turned[b, first:k]).sum(1)
                left = done + vrests[step][a] * rests[step][b] >= self.threshold - 1e-9
                a, b, done = a[left], b[left], done[left]
                self.counts[step + 1] += len(a)
            near = (vx[a] * x[b]).sum(1) / (vnorm[a] * norm[b]) >= self.threshold
            out_i.append(a[near])
            out_j.append(b[near])
        none = np.zeros(0, np.int64)
        i, j = np.concatenate([none, *out_i]), np.concatenate([none, *out_j])
        self.counts[-1] += len(i)
        return i, j

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Own vectors that one visitor links to hang on one root."""
        while len(i):
            r = self.root[j]
            least = np.full(i.max() + 1, len(self.root))
            np.minimum.at(least, i, r)
            if (r == least[i]).all():
                break
            np.minimum.at(self.root, r, least[i])
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]

    def compare(self, other, copies: np.ndarray, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(visitor, one of its links' roots, its number of links) for the visitors that have any."""
        i, j = self.pairs(other, skip)
        np.add.at(self.links, j, copies[i])
        links = np.zeros(len(copies), np.int64)
        np.add.at(links, i, self.copies[j])
        self.join(i, j)
        has, first = np.unique(i, return_index=True)
        return has, self.node[self.root[j[first]]], links[has]

    def visit(self, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for at in range(0, len(rows), CHUNK):
            some = rows.iloc[at : at + CHUNK]
            has, root, links = self.compare(self.made(some), some["copies"].to_numpy(np.int64))
            yield pd.DataFrame({"node": some["node"].to_numpy(np.int64)[has], "other": root, "links": links})

    def close(self) -> Iterator[pd.DataFrame]:
        for at in range(0, len(self.node), CHUNK):
            here = np.arange(at, min(at + CHUNK, len(self.node)))
            x, norm, turned, lead, rests = self.own
            mine = (x[here], norm[here], turned[here], lead[here], [r[here] for r in rests])
            has, root, links = self.compare(mine, self.copies[here], here)
            yield pd.DataFrame({"node": self.node[here][has], "other": root, "links": links})
        yield pd.DataFrame({"node": self.node, "other": self.node[self.root], "links": self.links})


class Tiles:
    """The tiles of one task; ``cells`` has each tile's place in ``meet``, which tells the cells that are compared."""

    def __init__(self, rows: pd.DataFrame, axes: dict[int, Axes], threshold: float, cells: np.ndarray, meet: np.ndarray) -> None:
        self.cells, self.meet = cells, meet
        self.rows = {int(t): own for t, own in rows.groupby("tile")}
        self.tiles = {t: Tile(own, axes, threshold) for t, own in self.rows.items()}

    def visit(self, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for cell, some in rows.groupby(self.cells[rows["tile"]]):
            for t, tile in self.tiles.items():
                if self.meet[cell, self.cells[t]]:
                    yield from tile.visit(some)

    def close(self) -> Iterator[pd.DataFrame]:
        for a, own in self.rows.items():
            for b, tile in self.tiles.items():
                if a < b and self.meet[self.cells[a], self.cells[b]]:
                    yield from tile.visit(own)
        for tile in self.tiles.values():
            yield from tile.close()


def tiles_of_a_task(tiles: int, rows: int, tasks: int = TASKS, held: int = HELD) -> int:
    """How many of ``tiles`` tiles with ``rows`` vectors one task holds."""
    return max(1, min(-(-tiles // tasks), held * tiles // max(1, rows)))


def fit_axes(vectors: DataFrame, rows: int, sample: int = FIT) -> dict[int, Axes]:
    """The axes for each length of vector (column vec), from the ``sample`` vectors of that length with the least hash."""
    lengths = {r["n"]: r["rows"] for r in vectors.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("rows")).collect()}  # a row for each length
    out = {}
    for n, many in lengths.items():
        some = vectors.filter(F.size("vec") == n).orderBy(F.xxhash64("vec"), "vec").limit(sample).select("vec").collect()
        out[n] = Axes(np.array([r["vec"] for r in some], float), min(CELLS, -(-many // rows)))
    return out


def links_of(classes: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(node, other, links) whose links add up to each node's number of linked vectors, and whose pairs (node, other) join all nodes that are linked.

    ``classes`` has node, vec (no zero, null or non-finite one) and copies: vectors that
    differ, and how many there are of each.
    """
    axes = fit_axes(classes, tile)
    schema = "node long, copies long, vec array<double>, length int, cell int, lead array<double>, rest double"
    lead = min([LEADING[0], *axes])
    placed = stage(classes.select("node", "copies", "vec").mapInPandas(_places(axes, lead), schema), "places")
    least, most = ([f(F.col("lead")[k]) for k in range(lead)] for f in (F.min, F.max))
    boxes = placed.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("rows"), F.array(*least).alias("low"), F.array(*most).alias("high"), F.max("rest").alias("rest"))
    boxes = boxes.orderBy("length", "cell").toPandas()  # at most CELLS rows for each length
    parts = [-(-int(n) // tile) for n in boxes["rows"]]
    first = np.concatenate([[0], np.cumsum(parts)]).astype(int).tolist()
    tiles = first[-1]
    spark = classes.sparkSession
    of = {(int(n), int(c)): k for k, (n, c) in enumerate(zip(boxes["length"], boxes["cell"]))}
    own = spark.createDataFrame([(n, c, first[k], parts[k]) for (n, c), k in of.items()], "length int, cell int, first int, parts int")
    back = {k: c for c, k in of.items()}
    meet = np.zeros((len(boxes), len(boxes)), bool)
    for i, j in meeting_cells(boxes, threshold):
        meet[i, j] = True
    cells = np.repeat(np.arange(len(boxes)), parts)
    many = tiles_of_a_task(tiles, int(boxes["rows"].sum()))
    shards = -(-tiles // many)
    visited = [(i, s) for i in range(len(boxes)) for s in np.unique(np.flatnonzero(meet[i][cells]) // many).tolist()]
    met = spark.createDataFrame([(*back[i], s) for i, s in visited], "length int, cell int, shard int")
    # both have at most CELLS, or CELLS squared, rows for each length
    d = placed.withColumn("salt", row_salt()).join(F.broadcast(own), ["length", "cell"])
    d = d.withColumn("tile", (F.col("first") + F.pmod("salt", F.col("parts"))).cast("int"))
    # single precision where it holds every component as it is
    single = F.col("vec").cast("array<float>")
    if not placed.filter(single.cast("array<double>") != F.col("vec")).isEmpty():
        single = F.col("vec")
    d = d.select("node", "copies", single.alias("vec"), "length", "cell", "tile", F.floor(F.col("tile") / many).cast("int").alias("home"))
    guests = d.join(F.broadcast(met), ["length", "cell"])
    # of two tasks the one's vectors go to the other; every task receives about as many as it sends
    ahead = F.pmod(F.col("shard") - F.col("home"), F.lit(shards))
    guests = guests.filter((ahead > 0) & ((2 * ahead < shards) | ((2 * ahead == shards) & (F.col("home") < F.col("shard")))))
    rows = ["node", "copies", "vec", "tile", "shard"]
    return visit_shards(
        d.withColumn("shard", F.col("home")).select(*rows),
        guests.select(*rows),
        shards,
        lambda _, r: Tiles(r, axes, threshold, cells, meet),
        "node long, other long, links long",
    )


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """``key``, n_links, component_id and kept for every row.

    Rows link at a cosine of ``threshold`` or more. A vector that is null, zero, or holds
    null or non-finite components links with nothing and is a component of its own, as
    does a vector with one of another length. Repeated rows are rows of their own that
    link with each other. A component is named by its smallest key; rows without a key
    are linked like any other, never name a component unless all its keys are null, and
    are kept only then; a row of its own is always kept. An empty table gives an empty result.
    """
    d = stage(rows.select(F.col(key).alias("key"), scaled_vector(F.col(vector)).alias("x")), "vectors")
    classes = d.filter("x IS NOT NULL").groupBy(F.col("x").alias("vec")).agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"))
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    if classes.isEmpty():
        found = classes.select("vec", F.lit(0).cast("long").alias("links"), F.col("least").alias("name"))
    else:
        links = stage(links_of(classes, threshold, tile), "links")
        counts = links.groupBy(F.col("node").alias("counted")).agg(F.sum("links").alias("links"))
        roots = components(links.select("node", "other"), "node", "other").select(F.col("node").alias("of"), "root")
        own = classes.join(counts, F.col("node") == F.col("counted"), "left").join(roots, F.col("node") == F.col("of"), "left")
        own = stage(own.select("vec", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("root", "node").alias("root")), "linked")
        names = own.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("name"))
        found = own.join(names, F.col("root") == F.col("of")).select("vec", "links", "name")
    # vectors that differ are one row each in ``found``; of the rows, a vector with very many copies is a join that Spark can split
    out = d.join(stage(found, "found"), F.col("x") == F.col("vec"), "left")
    name = F.when(F.col("vec").isNull(), F.col("key")).otherwise(F.col("name"))
    kept = F.col("vec").isNull() | F.coalesce(F.col("key") == F.col("name"), F.col("name").isNull())
    return out.select(F.col("key").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), name.alias("component_id"), kept.alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_contains([coalesce(isfinite(x), false) FOR x IN embedding], false)
    AND list_max([abs(x) FOR x IN embedding]) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
  ON a.vec_id <> b.vec_id AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.9 END
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach AS r JOIN links AS l ON r.b = l.a
), c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""
