import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from enrollspark.llm import mixing as M
from llm_data import clashing, documents, edge_rows


def brute_period(shares):
    """Earliest deadline first, simulated."""
    total, done, out = sum(shares), [0] * len(shares), []
    for t in range(total):
        ready = [(math.ceil(Fraction((done[i] + 1) * total, s)), i) for i, s in enumerate(shares) if done[i] < s and math.floor(Fraction(done[i] * total, s)) <= t]
        c = min(ready)[1]
        done[c] += 1
        out.append(c)
    return out


def test_slots_equal_a_simulation_and_stay_within_a_block(spark):
    r = random.Random(2)
    shares = [[r.randrange(0, 30) for _ in range(r.randrange(1, 9))] for _ in range(12)] + [[1], [50] + [1] * 40]
    shares = [s for s in shares if sum(s)]
    t = M._table(spark, [{"epoch": i, "shares": s} for i, s in enumerate(shares)], "epoch int, shares array<int>")
    rows = M.edf_slots(t).orderBy("epoch", "slot").collect()
    for e, s in enumerate(shares):
        got = [x["cls"] for x in rows if x["epoch"] == e]
        assert got == brute_period(s)
        for c, own in enumerate(s):
            for n in range(1, len(got) + 1):
                assert abs(Fraction(got[:n].count(c)) - Fraction(n * own, sum(s))) < 1


def test_epochs_use_every_block_once():
    r = random.Random(5)
    for _ in range(50):
        blocks = [r.randrange(0, 400) for _ in range(r.randrange(1, 8))]
        shares = [r.randrange(1, 20) for _ in blocks]
        used = [0] * len(blocks)
        at = 0
        for slot, repeats, own, first in M.epochs(blocks, shares):
            assert slot == at and first == used
            used = [u + repeats * s for u, s in zip(used, own)]
            at += repeats * sum(own)
        assert used == blocks


def stream(df):
    return df.orderBy("position").collect()


def test_stream_follows_the_shares(spark):
    rows = [(k, "t", "a" if k < 2000 else "b" if k < 2600 else "c") for k in range(3000)]
    d = documents(spark, rows)
    got = stream(M.mix_sources(d, {"a": 5, "b": 3, "c": 2}, block=8))
    assert sorted(r["doc_id"] for r in got) == list(range(3000))
    assert len({r["position"] for r in got}) == 3000
    blocks = []
    for r in got:
        if not blocks or blocks[-1][0] != r["slot"]:
            blocks.append((r["slot"], r["source"]))
        assert blocks[-1][1] == r["source"]  # a block is one source's
    assert [b[0] for b in blocks] == list(range(len(blocks)))
    for n in range(1, 240):  # 75 blocks of b and 50 of c: 25 whole periods
        for s, w in (("a", 5), ("b", 3), ("c", 2)):
            assert abs(sum(x[1] == s for x in blocks[:n]) - Fraction(n * w, 10)) < 1


def test_edges(spark):
    rows = [(i, t, s) for (i, t), s in zip(edge_rows(), ["a", None, "a", "b", "", "", None, "c", "c", "rest"])]
    d = clashing(documents(spark, rows), "block", "slot", "place", "position", "cls", "n", "period", "slots")
    out = M.mix_sources(d, {"a": 2, "b": 1}, block=2)
    assert out.columns[: len(d.columns)] == d.columns
    got = out.collect()
    assert len(got) == len(rows) and len({r["position_"] for r in got}) == len(rows)
    assert M.mix_sources(documents(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    out = M.mix_sources(documents(spark, [(k, "t", f"s{k % 3}") for k in range(50)]), block=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_files_in_name_order_are_the_stream(spark, tmp_out):
    rows = [(k, f"text {k}", f"s{k % 7 if k % 3 else 0}") for k in range(900)] + [(5, "again", "s1"), (None, "no id", "s2")]
    d = documents(spark, rows)
    M.mixed_order(d, block=8).write.parquet(tmp_out)
    back = spark.read.parquet(tmp_out).select("*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("m"))
    got = [r["doc_id"] for r in sorted(back.collect(), key=lambda r: (r["f"], r["m"]))]
    place = {r["doc_id"]: r["position"] for r in M.mix_sources(d.filter("doc_id is not null").dropDuplicates(["doc_id"]), block=8).collect()}
    assert got[-1] is None and len(got) == len(rows)
    assert [place[i] for i in got[:-1]] == sorted(place[i] for i in got[:-1])
