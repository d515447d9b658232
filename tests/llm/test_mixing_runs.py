"""Runs of the stream, scheduled apart, give the order of one schedule over the whole stream."""

import math
import random

import pytest

from enrollspark.llm import mixing as M
from test_mixing_weights import ideal


def whole(sizes, block):
    """Earliest deadline first, slot by slot; ties to the first name, null before all."""
    names = sorted(sizes, key=lambda n: (n is not None, n or ""))
    n, w = [-(-sizes[x] // block) for x in names], [math.sqrt(sizes[x]) for x in names]
    done, out = [0] * len(names), []
    for t in range(1, sum(n) + 1):
        v = _time(n, w, t)
        ready = [i for i in range(len(names)) if done[i] < n[i] and done[i] / w[i] < v] or [i for i in range(len(names)) if done[i] < n[i]]
        i = min(ready, key=lambda i: ((done[i] + 1) / w[i], i))
        out.append(names[i])
        done[i] += 1
    return out


def _time(n, w, t):
    """The virtual time after t slots."""
    left, total, rate = sorted((b / x, b, x) for b, x in zip(n, w)), 0, sum(w)
    best = 0.0
    for _, b, x in left:
        best = max(best, (t - total) / rate)
        total, rate = total + b, rate - x
        if rate <= 1e-9:
            break
    return best * (1 + 1e-12)


def stream(spark, sizes, block, run):
    t = M._table(spark, [{"name": n, "rows": r} for n, r in sizes.items()], "name string, rows bigint")
    rows = sorted(M.weighted_slots(t, block, run).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    for n, r in sizes.items():
        assert [x["block"] for x in rows if x["name"] == n] == list(range(-(-r // block)))
    return [r["name"] for r in rows]


def bounded(sizes, block, names, every):
    keys, blocks, weights = list(sizes), [-(-r // block) for r in sizes.values()], [math.sqrt(r) for r in sizes.values()]
    done = dict.fromkeys(sizes, 0)
    for t, name in enumerate(names, 1):
        done[name] += 1
        if t % every == 0:
            assert all(abs(done[k] - x) < 1 + 1e-6 for k, x in zip(keys, ideal(blocks, weights, t)))


@pytest.mark.parametrize("seed", range(6))
def test_runs_give_the_order_of_the_whole(spark, seed):
    r = random.Random(seed)
    sizes = {f"s{k:02d}": r.choice([1, 3, 20, 77, 400, 900]) * r.randrange(1, 4) for k in range(r.choice([2, 3, 7, 12]))} | ({None: 33} if seed % 2 else {})
    block = r.choice([2, 4, 8])
    got = stream(spark, sizes, block, r.choice([8, 40, 64]))
    assert got == whole(sizes, block)


def test_one_source(spark):
    assert stream(spark, {"a": 700}, 2, 16) == ["a"] * 350
    assert stream(spark, {None: 1}, 64, 256) == [None]


def test_twenty_sources(spark):
    sizes = {f"s{k:02d}": 40 + 97 * k * k for k in range(20)}
    names = stream(spark, sizes, 64, 256)
    assert names == whole(sizes, 64)
    bounded(sizes, 64, names, 29)


def test_a_thousand_sources(spark):
    sizes = {f"s{k:04d}": 1 + k * k % 700 for k in range(999)} | {"big": 150_000}
    names = stream(spark, sizes, 256, 256)
    bounded(sizes, 256, names, 701)
    assert len(names) > 2000  # three runs


def test_equal_weights_and_ties(spark):
    sizes = {f"s{k}": 50 for k in range(6)} | {"t": 200}
    assert stream(spark, sizes, 5, 8) == whole(sizes, 5)


def test_empty(spark):
    t = M._table(spark, [], "name string, rows bigint")
    assert M.weighted_slots(t, 64).count() == 0
