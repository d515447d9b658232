import random

import duckdb

from enrollspark.llm import preference as P
from enrollspark.llm import queries
from llm_data import SF, clashing

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, pairs):
    """Turn lists compared one by one."""
    by = {}
    for c, t, r, x in rows:
        if c is not None:
            by.setdefault(c, {}).setdefault(-1 if t is None else t, []).append((r, x))
    for turns in by.values():
        for v in turns.values():
            v.sort(key=lambda p: tuple((y is not None, y or "") for y in p))
    flat = {c: {(t, k): p for t, v in turns.items() for k, p in enumerate(v)} for c, turns in by.items()}
    out = []
    for i, a, b in set(pairs):
        x, y = flat.get(a, {}), flat.get(b, {})
        places = sorted({*x, *y})
        first = next((p for p in places if p not in x or p not in y or x[p] != y[p]), None)
        for part, side in (("chosen", x), ("rejected", y)):
            for p, (role, text) in side.items():
                common = first is None or p < first
                if common and part == "rejected":
                    continue
                seg = f"<|{role or ''}|>\n{text or ''}<|end|>\n"
                out.append((i, "prompt" if common else part, p[0], p[1], seg, not common and role == "assistant"))
    return sorted(out)


def run(spark, rows, pairs):
    c = clashing(spark.createDataFrame(rows, SCHEMA), "again", "pair_id", "side", "common", "first")
    p = spark.createDataFrame(pairs, "pair_id long, chosen long, rejected long")
    out = P.format_pairs(c, p)
    assert out.columns == ["pair_id", "part", "turn", "again", "segment", "trained"]
    return sorted(tuple(r) for r in out.collect())


def conversations(seed=1, n=40):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        rows += [(c, t, ("user", "assistant")[t % 2], f"turn {t} says {r.choice('ab') if t > 1 else 'a'}") for t in range(r.randrange(1, 7))]
    return rows


def test_equals_a_turn_by_turn_comparison(spark):
    rows = conversations()
    pairs = [(k, 2 * k, 2 * k + 1) for k in range(20)] + [(99, 3, 3), (98, 3, 4), (98, 3, 4)]
    assert run(spark, rows, pairs) == brute(rows, pairs)


def test_edges(spark):
    rows = [(0, None, "system", None), (0, 0, "user", "q"), (0, 0, "user", "q"), (0, 1, None, "x"), (1, None, "system", None), (1, 0, "user", "q"), (1, 1, None, "y"), (None, 0, "user", "lost"), (2, 5, "assistant", "y" * 100_000), (3, 5, "assistant", None)]
    pairs = [(0, 0, 1), (1, 2, 3), (2, 0, 77), (3, 77, 1), (4, 0, 0)]
    got = run(spark, rows, pairs)
    assert got == brute(rows, pairs)
    assert not [r for r in got if r[0] == 4 and r[1] != "prompt"]
    assert run(spark, [], pairs) == [] and run(spark, rows, []) == []


def test_prompt_and_completion_give_the_conversations_back(spark):
    rows = conversations(4)
    got = run(spark, rows, [(k, 2 * k, 2 * k + 1) for k in range(20)])
    for k in range(20):
        for part, c in (("chosen", 2 * k), ("rejected", 2 * k + 1)):
            text = "".join(r[4] for r in got if r[0] == k and r[1] in ("prompt",)) + "".join(r[4] for r in got if r[0] == k and r[1] == part)
            assert text == "".join(f"<|{r}|>\n{x}<|end|>\n" for cc, t, r, x in rows if cc == c)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(P.ORACLE).fetchall()
    assert sorted(tuple(r) for r in queries.op8_preference_format(spark, SF).collect()) == sorted(want)
