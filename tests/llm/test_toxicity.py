import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from enrollspark.llm import toxicity as X
from enrollspark.llm.common import crc_bucket, read_table
from llm_data import LABEL_SCHEMA, SF, clashing, documents, edge_rows, prose

BAD = ("vilestuff", "meanword", "rottenly")


def planted(n=400, seed=1):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w, toxic = prose(seed * 10_000 + i, r.randrange(40, 160)).split(" "), int(i % 5 == 0)
        for _ in range(4 * toxic):
            w.insert(r.randrange(len(w)), r.choice(BAD))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_learns_planted_words(spark):
    rows, labels = planted()
    m = X.learn_toxicity(documents(spark, rows), spark.createDataFrame(labels, LABEL_SCHEMA), F.lit(True))
    other, truth = planted(200, 9)
    got = {r["doc_id"]: r["score"] for r in X.score_toxicity(documents(spark, other), m).collect()}
    right = [(got[i] >= X.POINT) == bool(t) for i, _, t in truth]
    assert sum(right) / len(right) >= 0.97


def test_a_window_costs_less_with_the_dictionary_that_knows_it():
    rows, labels = planted()
    c = X.Coder()
    windows = {y: [w for (_, t), (_, _, z) in zip(rows, labels) if z == y for w in c.windows(t)] for y in (1, 0)}
    toxic, ordinary = X.train_dictionaries(windows[1], windows[0], 5.0, 2048)
    assert len(toxic) == len(ordinary) <= 2048
    for w in BAD:
        assert all(xxhash.xxh64_digest(u) in toxic and xxhash.xxh64_digest(u) not in ordinary for u in X.units(w))
    a = X.Advantage(toxic, ordinary)
    bad = a.features("the river bank holds vilestuff and some meanword too")
    good = a.features("the river bank holds stones and some water too")
    assert bad[0] >= 2 * X.FEW_BYTES and good[0] <= 1


def test_units_of_a_class_and_too_little_to_train_on():
    w = lambda *codes: b"".join(c * 8 for c in codes)
    toxic, ordinary = [w(b"a", b"x", b"x")] * 20, [w(b"a", b"b")] * 15 + [w(b"x")]
    assert X.own_units(toxic, ordinary, 5.0) == [[b"x" * 8]] * 20
    assert X.own_units(toxic, ordinary, 50.0) == [[]] * 20
    assert X.train_dictionary([], 1024) == b""
    a, b = X.train_dictionaries([], [], 5.0, 1024)
    assert a == b and X.Advantage(a, b).features("vilestuff and more") == (0.0, 0.0, 0.0, 0.0)


def test_held_out_accuracy(spark):
    d = SF.replace("0.001", "0.1")
    docs, labels = read_table(spark, d, "documents"), read_table(spark, d, "labels")
    held = crc_bucket(F.col("doc_id"), 4) == 2
    m = X.learn_toxicity(docs, labels, ~held)
    got = X.score_toxicity(docs.filter(held).join(labels, "doc_id"), m).select("toxic", "score").collect()
    caught = np.mean([r["score"] >= X.POINT for r in got if r["toxic"] == 1])
    spared = np.mean([r["score"] < X.POINT for r in got if r["toxic"] == 0])
    assert caught >= 0.85 and spared >= 0.95


def test_features_equal_a_brute_force(spark):
    rows, labels = planted(120)
    m = X.learn_toxicity(documents(spark, rows), spark.createDataFrame(labels, LABEL_SCHEMA), F.lit(True))
    a = X.Advantage(m.toxic, m.ordinary)
    got = {r["doc_id"]: r["score"] for r in X.score_toxicity(documents(spark, rows), m).collect()}
    for i, t in rows[:30]:
        gains = []
        for w in a.coder.windows(t):
            gains.append(len(a.compress[0](w)) - len(a.compress[1](w)))
        f = (max(gains), np.mean(gains), sum(g - 3 for g in gains if g > 3) / len(gains), sum(g > 3 for g in gains) / len(gains))
        z = sum((v - c) / s * w for v, c, s, w in zip(f, m.centre, m.scale, m.weights)) + m.weights[-1]
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-9


def test_edges(spark):
    d = clashing(documents(spark, edge_rows()), "features", "score_", "f")
    labels = spark.createDataFrame([(2, 1, 1), (4, 0, 0), (4, 1, 1), (None, 1, 1), (8, 1, None)], LABEL_SCHEMA)
    m = X.learn_toxicity(d, labels, F.lit(True))
    out = X.score_toxicity(d, m)
    assert out.columns == [*d.columns, "score"]
    rows = out.collect()
    assert len(rows) == len(edge_rows()) and all(0 < r["score"] < 1 for r in rows)
    none = X.learn_toxicity(d, labels.limit(0), F.lit(True))
    assert {r["score"] for r in X.score_toxicity(d, none).collect()} == {0.5}
    assert X.score_toxicity(documents(spark, []), m).count() == 0


def test_words_units_and_codes():
    assert X.words("The (VILE) words! - été") == ["the", "vile", "words", "été"]
    assert X.units("word") == ["word"] and X.units("words") == ["word-", "words"]
    c = X.Coder()
    assert len(c.windows(" ".join(["w"] * 70))) == 3 and c.windows("") == [] and c.windows(None) == []
    c("x" * 1000)
    assert len(c.known) == 1
