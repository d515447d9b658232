import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from enrollspark.llm import queries
from enrollspark.llm import segments as S
from llm_data import SF, clashing

V = "vec_id long, label long, vec array<long>"


def brute(vectors, anchors):
    """vectors and anchors as (id, label, vec); anchors have distinct ids."""
    out = []
    for a, la, va in anchors:
        score = [(sum(x * y for x, y in zip(v, va)), i, l == la) for i, l, v in vectors if i != a and len(v) == len(va)]
        score = sorted((-s, i, same) for s, i, same in score)
        for p, pid in [(-s, i) for s, i, same in score if same][:5]:
            hard = [(i, -s) for s, i, same in score if not same and 50 * p <= -100 * s <= 95 * p][:3]
            out += [(a, pid, k + 1, n, p, s) for k, (n, s) in enumerate(hard)]
    return sorted(out)


def run(spark, vs, anchors):
    a = spark.createDataFrame(anchors, V.replace("vec_id", "anchor_id"))
    return sorted(tuple(r) for r in S.hard_negatives(spark.createDataFrame(vs, V), a).collect())


def test_equals_brute_force_over_shards(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD_ROWS", 150)
    r = random.Random(3)
    vs = [(i, r.randrange(3), [r.randrange(-20, 40) for _ in range(20)]) for i in range(500)]
    vs += [(1000 + i, i % 2, [7] * 20) for i in range(40)]  # ties
    got = run(spark, vs, vs[::13])
    assert got == brute(vs, vs[::13]) and len(got) > 100


def test_scores_at_the_limits_negative_and_zero(spark):
    p = (1, 0, [10, 0])
    vs = [p, (2, 0, [10, 0]), (3, 1, [5, 0]), (4, 1, [9, 0]), (5, 1, [10, 0]), (6, 1, [4, 9]), (7, 0, [-3, 0]), (8, 0, [0, 1]), (9, 1, [0, 5]), (10, 1, [-2, 1])]
    want = brute(vs, [p])
    assert run(spark, vs, [p]) == want
    assert {w[3] for w in want} >= {3, 4, 9}  # 50 of 100, 90 of 100, and 0 of 0


def test_odd_rows(spark):
    vs = [(1, 0, [1, 2]), (1, 0, [1, 2]), (None, 0, [9, 9]), (2, None, [1, 1]), (3, 1, None), (4, 0, [2, 2]), (5, 1, [1, 2]), (5, 1, [1, 2]), (6, 1, [5]), (7, 1, [])]
    kept = [v for v in vs if None not in v]
    anchors = [(4, 0, [2, 2]), (4, 0, [2, 2]), (7, 1, []), (None, 0, [1, 1]), (8, 0, None)]
    # repeated positives and negatives count as often as they come
    assert run(spark, vs, anchors) == brute(kept, [anchors[0], anchors[2]])
    assert run(spark, [], anchors) == [] and run(spark, vs, []) == []


def test_large_components_are_exact(spark):
    b = 1 << 30
    vs = [(1, 0, [b, 3, -b, 1]), (2, 0, [b, 1, -b, 7]), (3, 1, [b // 2, 5, -b // 2, 1]), (4, 1, [b, 5, -b // 2, 1]), (5, 1, [b, 5, -b, 1])]
    assert run(spark, vs, vs[:2]) == brute(vs, vs[:2])


def test_labels_are_flipped_and_bad_vectors_left_out(spark):
    rows = [(0, [0.5, 0.1], 9), (1, [0.5, 0.2], 0), (2, [0.4, 0.2], 1), (3, [float("nan"), 1.0], 1), (4, [None, 1.0], 1), (5, None, 1), (6, [0.4, 0.1], None), (7, [0.3, 0.2], 9)]
    d = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), "shard", "vec", "score", "rank", "low")
    got = sorted(tuple(r) for r in S.embedding_negatives(d).collect())
    v = [(i, (l + 1) % 10 if i % 7 == 0 else l, [int(np.floor(256 * np.float32(x).astype(float))) for x in e]) for i, e, l in rows if i in (0, 1, 2, 7)]
    assert got == brute(v, [x for x in v if x[0] == 0]) and got
    assert S.embedding_negatives(d.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_leave_pairs_out(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-90, 90, (300, 23)) + 200 * rng.integers(-1, 2, (300, 1))
    for n in (1, 4, 16, 40):
        low, high = S.bounds(S.summary(x[:40].astype(float), n), S.summary(x.astype(float), n))
        p = x[:40] @ x.T
        assert (low <= p).all() and (p <= high).all()
    rows = pd.DataFrame({"vec_id": np.arange(300), "label": np.zeros(300, int), "vec": list(x)})
    shard = S.SegmentShard(rows, True, 5)
    every = np.full((40, 1), S.LOWEST), np.full((40, 1), S.HIGHEST)
    shard.search(np.arange(40), np.zeros(40, int), x[:40], *every)
    bars = np.sort(x[:40] @ x.T, 1)[:, -6:-5]
    tight = S.SegmentShard(rows, True, 5)
    tight.search(np.arange(40), np.zeros(40, int), x[:40], bars, every[1])
    assert tight.counts[1] < tight.counts[0] and tight.counts[2] < tight.counts[1]  # each level leaves fewer


def test_query_equals_sql(spark):
    d = SF.replace("0.001", "0.01")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    q = queries.op11_hard_negatives(spark, d)
    want = con.execute(S.ORACLE).fetchall()
    assert q.columns == [c[0] for c in con.description]
    assert sorted(tuple(r) for r in q.collect()) == sorted(want)
