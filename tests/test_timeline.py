"""The distinct spans of a member's timeline rows, against the rows themselves."""

from collections import defaultdict

from conftest import SF_SMALL
from helpers import strings
from pyspark.sql import functions as F

from enrollspark.operators.change import member_timeline, with_distinct_spans
from enrollspark.plans.queries import QUERIES
from enrollspark.sources import fixtures as fx

SPAN = ["CM_ELIG_GRGR_CK", "CM_ELIG_EFF_DT", "CM_ELIG_TERM_DT"]


def spans_of(rows, by):
    found = defaultdict(set)
    for r in rows:
        found[tuple(r[c] for c in by)].add(tuple(r[c] for c in SPAN))
    return {k: len(v) for k, v in found.items()}


def test_distinct_spans_are_those_of_the_joined_rows(spark):
    """Twins, repeated DEMO rows, null parts of a span, policies in several parts, no policy, no span."""
    demo = strings(spark, ["RECORD_TYPE", "CM_DEMO_MEME_CK"], [("x", m) for m in ("1", "1", "2", "3", "none", None)])
    spans = [("1", "g", "a", "b")] * 3 + [("1", "g", "a", None)] * 2 + [("1", None, None, None), ("1", "h", "a", "b"), ("2", "g", "a", "b"), ("3", None, None, None), (None, "g", "a", "b")]
    elig = strings(spark, ["RECORD_TYPE", "CM_ELIG_MEME_CK", *SPAN], [("x", *s) for s in spans])
    cob = strings(spark, ["RECORD_TYPE", "CM_COB_MEME_CK", "P"], [("x", "1", f"p{k % 7}") for k in range(30)] + [("x", "2", None), ("x", None, "p")])
    counted = with_distinct_spans(demo, elig, "n")
    assert counted.count() == demo.count() and counted.filter("n IS NULL").count() == 2
    rows = member_timeline(counted, elig, cob, policies=4).collect()
    by = ["CM_DEMO_MEME_CK", "P"]
    want = spans_of(rows, by)
    assert want == {("1", f"p{k}"): 4 for k in range(7)} | {("2", None): 1, ("3", None): 1}
    assert {tuple(r[c] for c in by): r["n"] for r in rows} == want


def test_the_query_tells_the_distinct_spans(spark):
    d, by = SF_SMALL, ["CM_DEMO_MEME_CK", "CM_COB_POLICY_ID", "CM_COB_EFF_DT"]
    got = QUERIES["member_timeline_rows"](spark, d)
    rows = member_timeline(fx.demo(spark, d), fx.elig(spark, d), fx.cob(spark, d)).select(*by, *SPAN).collect()
    assert {tuple(r[c] for c in by): r["distinct_spans"] for r in got.collect()} == spans_of(rows, by)
    assert got.filter(F.col("distinct_spans") < F.col("timeline_rows")).count() > 0  # twins are one span
