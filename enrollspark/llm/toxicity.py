"""Toxicity by compression distance.

Every word is recoded to two 8-byte hashes, one of its first letters and one of the whole
word, so that a match in a dictionary is a word or a beginning and never a chance run of
letters. One zstandard dictionary is trained on windows of toxic labelled texts and one
on windows of ordinary ones; from the windows of each go, before training, the units that
are not several times as frequent there as in the other's windows, as what both share costs the same with either.
A window is compressed with each dictionary; what the toxic one saves over the ordinary
one is its advantage. A document's advantages (the largest, the mean, the mean beyond a
few bytes, the share of such windows) go through a logistic curve calibrated on
labelled rows.

Fitting takes at most ``MAX_FIT`` labelled documents, those with the smallest hash of
their id, and at most ``MAX_WINDOWS`` windows of either label; scoring takes all documents
and whole texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrollspark.llm.common import private, stage, text_or_empty
from enrollspark.llm.rules import MAX_FIT, cut_for, labelled_sample

START = 4  # letters of a word's beginning
WINDOW = 32  # words
MAX_WINDOWS = 10_000  # of a label
# how many times as frequent a unit must be in its own windows, and a dictionary's bytes; held-out rows choose
TRIED = ((5.0, 1024), (12.0, 1024), (8.0, 2048), (8.0, 8192))
HEADER = 256  # bytes of a dictionary's header at most
LEAST_DOCS = 5  # of a label in a fold, to choose by
CODE = 8
POINT = 0.3
SEED = 7
MARKS = ".,;:!?\"'()[]{}#*$%&|<>-_"
FEATURES = ("most", "mean", "beyond", "share")
FEW_BYTES = 3
MOST_CACHED, LONGEST_CACHED = 1 << 20, 64


def words(text: str | None) -> list[str]:
    return [w for w in (x.strip(MARKS) for x in (text or "").lower().split()) if w]


def units(word: str) -> list[str]:
    """A word's beginning, marked by a sign that no word ends with, and the word; a word no longer than that is itself alone."""
    return [word[:START] + "-", word] if len(word) > START else [word]


class Coder:
    """Word to the 8-byte codes of its units; remembers a bounded number of words of bounded length."""

    def __init__(self) -> None:
        self.known: dict[str, bytes] = {}

    def __call__(self, word: str) -> bytes:
        code = self.known.get(word)
        if code is None:
            code = b"".join(xxhash.xxh64_digest(u.encode("utf-8", "surrogatepass")) for u in units(word))
            if len(word) <= LONGEST_CACHED:
                if len(self.known) >= MOST_CACHED:
                    self.known.clear()
                self.known[word] = code
        return code

    def windows(self, text: str | None) -> list[bytes]:
        codes = list(map(self, words(text)))
        return [b"".join(codes[k : k + WINDOW]) for k in range(0, len(codes), WINDOW)]


class Advantage:
    """Bytes that the toxic dictionary saves over the ordinary one, by window."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        self.coder = Coder()
        self.compress = []
        for d in (ordinary, toxic):
            dictionary = zs.ZstdCompressionDict(d, dict_type=zs.DICT_TYPE_RAWCONTENT)
            params = zs.ZstdCompressionParameters(
                window_log=16, hash_log=15, chain_log=15, search_log=4, min_match=6, strategy=zs.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0
            )
            dictionary.precompute_compress(compression_params=params)
            self.compress.append(zs.ZstdCompressor(dict_data=dictionary, compression_params=params).compress)

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        ordinary, toxic = self.compress
        a = [len(ordinary(w)) - len(toxic(w)) for w in self.coder.windows(text)]
        if not a:
            return 0.0, 0.0, 0.0, 0.0
        beyond = [x - FEW_BYTES for x in a if x > FEW_BYTES]
        return float(max(a)), sum(a) / len(a), sum(beyond) / len(a), len(beyond) / len(a)


FEATURE_TYPE = T.StructType([T.StructField(n, T.DoubleType()) for n in FEATURES])


def window_features(text: Column, toxic: bytes, ordinary: bytes) -> Column:
    @F.pandas_udf(FEATURE_TYPE)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        made = Advantage(toxic, ordinary)
        for texts in parts:
            yield pd.DataFrame([made.features(t) for t in texts], columns=FEATURES, dtype=float)

    return run(text)


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]  # the intercept last

    def score(self, features: str) -> Column:
        total = F.lit(self.weights[-1])
        for n, c, s, w in zip(FEATURES, self.centre, self.scale, self.weights):
            total = total + (F.col(f"{features}.{n}") - F.lit(c)) / F.lit(s) * F.lit(w)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _codes(window: bytes) -> list[bytes]:
    return [window[k : k + CODE] for k in range(0, len(window), CODE)]


def own_units(windows: list[bytes], others: list[bytes], ratio: float) -> list[list[bytes]]:
    """Of each window the units, once each, that are at least ``ratio`` times as frequent in ``windows`` as in ``others``."""
    here, there = (Counter(c for w in part for c in set(_codes(w))) for part in (windows, others))
    keep = {c for c, n in here.items() if (n + 0.5) / (len(windows) + 1) >= ratio * (there[c] + 0.5) / (len(others) + 1)}
    return [[c for c in dict.fromkeys(_codes(w)) if c in keep] for w in windows]


def train_dictionary(windows: list[list[bytes]], size: int) -> bytes:
    """A zstandard dictionary of at most ``size`` bytes in segments of one code; empty where there is too little to train on.

    A sample is a code, so no run across two of them counts. zstandard puts what it chose first at the end
    and cuts up to ``HEADER`` bytes off there for its header; codes of no unit, the most frequent, are chosen before all units.
    """
    rng = np.random.default_rng(SEED)
    first = [rng.bytes(CODE) for _ in range(HEADER // CODE)]
    samples = [c for w in windows if w for c in (*first, *w)]
    try:
        return zs.train_dictionary(size, samples, k=CODE, d=CODE, level=3).as_bytes() if samples else b""
    except zs.ZstdError:  # its answer to too few samples
        return b""


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes], ratio: float, size: int) -> tuple[bytes, bytes]:
    """(toxic, ordinary): each trained on its own windows; the shorter filled up in front, so that distances compare."""
    made = [train_dictionary(own_units(a, b, ratio), size) for a, b in ((toxic, ordinary), (ordinary, toxic))]
    n = max(CODE, *map(len, made))
    fill = np.random.default_rng(SEED).bytes(n)
    return tuple(fill[: n - len(d)] + d for d in made)


def calibrate(x: np.ndarray, y: np.ndarray, point: float = POINT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and logistic weights, both labels weighing the same; the cut that parts them best gets ``point``."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return np.zeros(x.shape[1]), np.ones(x.shape[1]), np.append(np.zeros(x.shape[1]), np.log(share / (1 - share)))
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    heavy = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(z.shape[1])
    ridge = np.diag([1e-2 * len(y)] * x.shape[1] + [1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        step = np.linalg.solve((z.T * (heavy * p * (1 - p))) @ z + ridge, z.T @ (heavy * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    w[-1] += float(np.log(point / (1 - point))) - cut_for(z @ w, y)
    return centre, scale, w


def _windows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    coder = Coder()
    for part in parts:
        rows = [(y, k, xxhash.xxh64_intdigest(w) >> 1, w) for t, y, k in zip(part["text"], part["label"], part["kept"]) for w in coder.windows(t)]
        yield pd.DataFrame(rows, columns=["label", "kept", "h", "codes"])


def _sample_windows(sample: DataFrame) -> dict[int, list[tuple[bool, bytes]]]:
    """By label (kept, codes) of at most ``MAX_WINDOWS`` windows, those with the smallest hash; a window is at most 512 bytes."""
    made = sample.select("text", F.col("label").cast("int").alias("label"), "kept").mapInPandas(_windows, "label int, kept boolean, h long, codes binary")
    made = stage(made, "windows")
    count = {r["label"]: r["count"] for r in made.groupBy("label").count().collect()}
    out = {}
    for y in (1, 0):
        share = min(1.0, 0.9 * MAX_WINDOWS / max(1, count.get(y, 0)))
        some = made.filter((F.col("label") == y) & (F.col("h") <= min((1 << 63) - 1, int(share * (1 << 63)))))
        out[y] = sorted((r["kept"], bytes(r["codes"])) for r in some.orderBy("h", "kept").limit(MAX_WINDOWS).collect())
    return out


def learn_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, most: int = MAX_FIT) -> ToxicityModel:
    """Fit from labelled documents; of equal texts one counts. One label only: a constant score.

    How much more frequent a unit must be in its own windows, and a dictionary's size, are chosen on a quarter
    of the labelled documents, which the dictionaries and the curve are not learnt from; the model is then fitted on all.
    """
    sample = labelled_sample(docs, labels, "toxic", learn, most).withColumn("text", text_or_empty(F.col("text")))
    sample = sample.groupBy(F.xxhash64("text").alias("h")).agg(F.min_by(F.struct("doc_id", "text", "label"), "doc_id").alias("r"))
    sample = stage(sample.select("r.*", (F.pmod("h", F.lit(4)) == 0).alias("kept")), "labelled")
    windows = _sample_windows(sample)
    size = {(r["kept"], r["label"]): r["count"] for r in sample.groupBy("kept", "label").count().collect()}

    def fit(by: tuple[float, int], folds: tuple[bool, ...]) -> tuple[bytes, bytes]:
        return train_dictionaries(*([w for k, w in windows[y] if k in folds] for y in (1, 0)), *by)

    def features(pair: tuple[bytes, bytes]):
        rows = sample.select("doc_id", "label", "kept", window_features(F.col("text"), *pair).alias("f")).select("doc_id", "label", "kept", "f.*").collect()
        rows.sort(key=lambda r: r["doc_id"])
        x = np.array([[r[n] for n in FEATURES] for r in rows], float).reshape(len(rows), len(FEATURES))
        return x, np.array([r["label"] for r in rows], float), np.array([r["kept"] for r in rows], bool)

    by = TRIED[0]
    if all(size.get((f, y), 0) >= LEAST_DOCS for f in (True, False) for y in (0, 1)):
        worth = []
        for tried in TRIED:
            x, y, kept = features(fit(tried, (False,)))
            centre, scale, w = calibrate(x[~kept], y[~kept])
            margin = ((x - centre) / scale) @ w[:-1] + w[-1]
            good, bad = np.sort(margin[kept & (y == 0)]), margin[kept & (y == 1)]
            # the share of pairs in the right order, ties half
            worth.append(float((np.searchsorted(good, bad, "left") + np.searchsorted(good, bad, "right")).mean()) / 2 / len(good))
        by = TRIED[int(np.argmax(worth))]
    pair = fit(by, (True, False))
    x, y, _ = features(pair)
    return ToxicityModel(*pair, *(tuple(map(float, v)) for v in calibrate(x, y)))


def score_toxicity(docs: DataFrame, model: ToxicityModel, score: str = "score", text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, higher: more toxic) from the whole text; null and empty texts have no window and score as such."""
    (f,) = private(docs, "features")
    d = docs.select("*", window_features(F.col(text), model.toxic, model.ordinary).alias(f))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], model.score(f).alias(score))
