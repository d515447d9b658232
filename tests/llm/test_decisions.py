import random

from pyspark.sql import functions as F

from enrollspark.llm import decisions
from enrollspark.llm.common import crc_bucket, read_table
from enrollspark.llm.textstats import COUNTS
from llm_data import LABEL_SCHEMA, SF, clashing, documents, edge_rows, prose
from test_textstats import counts

SF_01 = SF.replace("0.001", "0.01")


def table(spark, f, n=900, seed=3):
    r = random.Random(seed)
    rows = [(r.random(), r.random(), r.random()) for _ in range(n)]
    return spark.createDataFrame([(*x, int(f(*x))) for x in rows], "a double, b double, c double, good int")


def test_covers_a_planted_conjunction(spark):
    bad = lambda a, b, c: a > 0.7 and b <= 0.4
    m = decisions.learn_list(table(spark, lambda a, b, c: not bad(a, b, c)), "good", ["a", "b", "c"])
    assert m.rules and {m.names[t[0]] for r in m.rules for t in r} == {"a", "b"}
    d = table(spark, lambda a, b, c: not bad(a, b, c), seed=4)
    wrong = d.filter(m.kept() != (F.col("good") == 1)).count()
    assert wrong / 900 < 0.08


def test_rules_apply_in_order():
    m = decisions.DecisionList(("a", "b"), (((0, True, 1.0),), ((0, False, 0.0), (1, True, 2.0))))
    text = m.kept("p_").__repr__()
    assert text.index("p_b") > text.index("p_a") and "CASE" in text


def test_one_label_or_no_rows_keep_everything(spark):
    d = table(spark, lambda *x: True, 60)
    assert decisions.learn_list(d, "good", ["a", "b"]).rules == ()
    assert decisions.learn_list(d.limit(0), "good", ["a", "b"]).rules == ()


def test_judged_documents(spark):
    docs, labels = read_table(spark, SF_01, "documents"), read_table(spark, SF_01, "labels")
    out = decisions.judge(docs, labels, crc_bucket(F.col("doc_id"), 5) != 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    right = seen = 0
    for r in out.collect():
        want = counts(text[r["doc_id"]])
        assert tuple(r[c] for c in COUNTS[:5]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and (not failed or not r["kept"])
        if crc(r["doc_id"]) % 5 == 0 and r["doc_id"] in quality and not failed:
            seen += 1
            right += r["kept"] == (quality[r["doc_id"]] == 1)
    assert right / seen >= 0.9


def crc(i):
    import zlib

    return zlib.crc32(str(i).encode())


def test_edges(spark):
    docs = clashing(documents(spark, [*edge_rows(), (30, prose(9, 200))]), "kept", "st_n_words")
    labels = spark.createDataFrame([(30, 1, 0), (None, 0, 0), (4, None, 0)], LABEL_SCHEMA)
    rows = decisions.judge(docs, labels, F.lit(True)).collect()
    assert len(rows) == len(edge_rows()) + 1
    assert {r["doc_id"]: r["kept"] for r in rows}[30] is True
    assert all(not r["kept"] and r["n_words"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert decisions.judge(documents(spark, []), labels, F.lit(True)).count() == 0
