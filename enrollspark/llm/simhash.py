"""SimHash near-duplicates, compared at anchor points.

A 64-bit fingerprint is cut into three blocks. If two fingerprints differ in at most
four bits, then in the first block by at most 1, or in the second by at most 1, or in
the third by 0, since 2 + 2 + 1 > 4. Each block has a covering code whose words are the
anchors: the perfect binary Golay code of length 23, covering radius 3, on the first two,
and on the last 18 bits the code of all words, covering radius 0. A fingerprint goes to
every anchor within covering radius plus the block's threshold; two fingerprints that
are close in a block then meet at the anchor that covers one of them. At an anchor the
whole fingerprints are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrollspark.llm.common import private, stage
from enrollspark.llm.components import components

SHINGLE = 4
BITS = 4
SEED = 42
ROWS_PER_TASK = 50_000  # of fingerprints at anchors: few bytes, but compared with each other
MOST_AT_ANCHOR = 4096  # fingerprints compared in one group; an anchor with more is dealt to pairs of parts


@dataclass(frozen=True)
class Block:
    """``length`` bits from bit ``low`` on, the code's generator polynomial (0: all words), its covering radius and the threshold."""

    low: int
    length: int
    poly: int
    radius: int
    within: int


GOLAY = 0b110001110101  # fixed value: generator polynomial of the binary Golay code
BLOCKS = (Block(0, 23, GOLAY, 3, 1), Block(23, 23, GOLAY, 3, 1), Block(46, 18, 0, 0, 0))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint, unsigned; no words: 0. Only A-Z are lowered; words part at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=starts[1:])
    ends = starts[min(shingle, len(words)) :][:n] - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends.tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 65_536):
        bits = np.unpackbits(hashes[k : k + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int((np.uint64(1) << np.arange(64, dtype=np.uint64))[2 * ones > n].sum(dtype=np.uint64))


@F.pandas_udf(T.LongType())
def _fingerprints(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in parts:
        yield pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).astype(np.int64))


def _syndromes(length: int, poly: int) -> np.ndarray:
    """The syndrome of each single bit: its power of x modulo the polynomial."""
    r = poly.bit_length() - 1
    out = []
    for k in range(length):
        v = 1 << k
        for b in range(length - 1, r - 1, -1):
            if v >> b & 1:
                v ^= poly << (b - r)
        out.append(v)
    return np.array(out, np.int64)


def _errors(block: Block) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bit syndromes, and for each syndrome the patterns that lead to a code word within radius + threshold."""
    one = _syndromes(block.length, block.poly)
    by: list[list[int]] = [[] for _ in range(1 << (block.poly.bit_length() - 1))]
    for weight in range(block.radius + block.within + 1):
        for places in combinations(range(block.length), weight):
            s = e = 0
            for p in places:
                s ^= int(one[p])
                e |= 1 << p
            by[s].append(e)
    return one, [np.array(x, np.int64) for x in by]


def anchors(fps: np.ndarray, block: Block, errors=None) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``fps``, anchor) for every anchor of the block near each fingerprint."""
    x = (fps.astype(np.uint64) >> np.uint64(block.low)).astype(np.int64) & ((1 << block.length) - 1)
    if not block.poly:
        return np.arange(len(x)), x
    one, by = errors or _errors(block)
    s = np.zeros(len(x), np.int64)
    for k in range(block.length):
        s ^= np.where(x >> k & 1, one[k], 0)
    sizes = np.array([len(p) for p in by])[s]
    place = np.repeat(np.arange(len(x)), sizes)
    found = np.concatenate([by[v] for v in s]) if len(s) else np.zeros(0, np.int64)
    return place, x[place] ^ found


def _at_anchors(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    errors = [_errors(b) if b.poly else None for b in BLOCKS]
    for part in parts:
        fps = part["fp"].to_numpy(np.int64)
        for lo in range(0, len(fps), 20_000):
            some = fps[lo : lo + 20_000]
            for k, block in enumerate(BLOCKS):
                place, anchor = anchors(some, block, errors[k])
                yield pd.DataFrame({"anchor": anchor * len(BLOCKS) + k, "fp": some[place]})


def forest(fps: np.ndarray, split: int | None = None, bits: int = BITS) -> list[tuple[int, int]]:
    """Links that join all fingerprints within ``bits``, without cycles; with ``split`` only between the first ``split`` and the rest."""
    u = fps.astype(np.uint64)
    label = np.arange(len(u))
    out = []
    for i in range(len(u) if split is None else split):
        lo = i + 1 if split is None else split
        near = lo + np.flatnonzero(np.bitwise_count(u[lo:] ^ u[i]) <= bits)
        found, first = np.unique(label[near], return_index=True)
        for other, j in zip(found.tolist(), near[first].tolist()):
            if other != label[i]:
                label[label == other] = label[i]
                out.append((int(fps[i]), int(fps[j])))
    return out


def _compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """Links within one cell of an anchor: a part with itself, or one part against another."""
    _, one, two = key
    if one == two:
        links = forest(np.sort(part["fp"].to_numpy(np.int64)))
    else:
        first = np.sort(part.loc[part["part"] == one, "fp"].to_numpy(np.int64))
        rest = np.sort(part.loc[part["part"] == two, "fp"].to_numpy(np.int64))
        links = forest(np.concatenate([first, rest]), len(first))
    return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)


def near_links(fps: DataFrame, most: int = MOST_AT_ANCHOR) -> DataFrame:
    """(a, b) over distinct fingerprints (column fp): links of at most BITS bits that join all that are within BITS bits.

    Null fingerprints meet nothing; an empty table gives no links. An anchor has one group, unless more than ``most`` fingerprints come to it: its
    fingerprints are then dealt to parts, and every pair of parts is a group. No
    fingerprint or pair is left out.
    """
    at = stage(fps.select("fp").mapInPandas(_at_anchors, "anchor long, fp long"), "anchors")
    counts = at.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    counts = counts.select("anchor", F.ceil(F.col("n") / most).cast("int").alias("parts"))
    d = at.join(stage(counts, "crowds"), "anchor")
    d = d.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    d = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    d = d.select("anchor", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"), "part", "fp")
    # by rows, as Spark would count bytes and give the comparisons to few tasks
    d = d.repartition(max(1, -(-at.count() // ROWS_PER_TASK)), "anchor", "one", "two")
    return d.groupBy("anchor", "one", "two").applyInPandas(_compare, "a long, b long").distinct()


def fingerprints(docs: DataFrame, out: str, text: str = "text") -> DataFrame:
    """Add ``out``: the fingerprint as a signed long. Null and empty texts have fingerprint 0 and link like any other."""
    return docs.select("*", _fingerprints(F.col(text)).alias(out))


def near_groups(docs: DataFrame) -> DataFrame:
    """(fp, component_id): each fingerprint's group, named by the smallest doc_id in it.

    ``docs`` has doc_id and fp. Null ids never name a group, unless all its ids
    are null: its name is then null. Equal fingerprints are one before they are compared.
    """
    classes = stage(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = stage(components(near_links(classes)), "roots")
    own = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = own.groupBy("root").agg(F.min("least").alias("component_id"))
    return own.join(names, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row, repeated rows included."""
    d = stage(fingerprints(docs.select("doc_id", "text"), "fp").select("doc_id", "fp"), "fingerprints")
    groups = stage(near_groups(d).select("fp", "component_id"), "groups")
    return d.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group, with its own columns: the one with the smallest doc_id, null after all others.

    Of rows with equal ids in one group the one with the smallest fingerprint stays, then the one with the
    smallest hash of its whole text, then the first in the staged table; two groups that hold the same id
    both keep a row. Fingerprints and ids are staged and the row chosen by its place there, so a repeated
    task chooses the same; texts are read once more for the rows kept and move once to meet their
    places, by one plan at every size: the places kept grow with the rows and aren't broadcast.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    fp, digest, place, root = private(docs, "fp", "digest", "place", "root")
    d = fingerprints(docs, fp).withColumn(digest, F.xxhash64("text")).withColumn(place, F.monotonically_increasing_id())
    rows = stage(d, "fingerprinted")
    groups = stage(near_groups(rows.select("doc_id", F.col(fp).alias("fp"))), "groups").select(F.col("fp").alias(f"{fp}_g"), F.col("root").alias(root))
    ids = rows.select("doc_id", fp, digest, place).join(groups, F.col(fp) == F.col(f"{fp}_g"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(fp), F.col(digest), F.col(place))
    kept = stage(ids.groupBy(root).agg(F.min(order).alias("first")).select(F.col(f"first.{place}").alias(root)), "kept")
    return rows.join(kept.hint("merge"), F.col(place) == F.col(root), "left_semi").select(*own)
