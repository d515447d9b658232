"""Registrations with very many ties: the extract's rows grow with spans times ties, what is moved and staged doesn't."""

import os
from collections import Counter

import pytest
from conftest import SF_SMALL
from helpers import strings
from pyspark.sql import functions as F

from enrollspark.operators.providers import IDS, PRINTED_ID, latest_ids, with_registration
from enrollspark.operators.records import SORT_KEYS, elig_records, with_body
from enrollspark.operators.spans import span_detail
from enrollspark.plans.extract import build_extract, record_bodies, write_extract
from enrollspark.plans.queries import QUERIES, _file_lines
from enrollspark.session import shared_dir
from enrollspark.sources import fixtures as fx

PRPR, PRRG = ["PRPR_ID", "PRCR_ID"], ["PRCR_ID", "PRRG_MCTR_TYPE", "PRRG_SEQ_NO", "PRRG_ID"]


def tied(spark, ties=300):
    spans = strings(spark, ["TAG", "CM_PRPR_ID"], [(f"s{k}", f"P{k % 2}") for k in range(40)] + [("none", None)])
    prpr = strings(spark, PRPR, [("P0", "C"), ("P1", "C"), (None, "C")])
    return spans, prpr, strings(spark, PRRG, [("C", "MD", "9", f"M{k}") for k in range(ties)] + [("C", "MD", "8", "old")])


def test_spans_are_dealt_to_tasks_before_they_are_multiplied(spark):
    """Two providers and one group: before, the rows of a provider were in one task."""
    out = with_registration(*tied(spark))
    assert Counter(r["TAG"] for r in out.collect()) == Counter({f"s{k}": 300 for k in range(40)} | {"none": 1})
    by_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(by_task) == tasks and max(by_task) <= 2 * out.count() / tasks


def test_a_body_is_encoded_once_a_span(spark):
    d = SF_SMALL
    detail, ref = span_detail(fx.elig(spark, d), fx.demo(spark, d), fx.AS_OF), (fx.prpr(spark, d), fx.prrg(spark, d))
    early, late = elig_records(with_registration(with_body(detail), *ref)), elig_records(with_registration(detail, *ref))
    assert Counter(map(tuple, early.collect())) == Counter(map(tuple, late.collect()))
    plan = QUERIES["elig_records"](spark, d)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("AS rec_type") < plan.index("Join LeftOuter") < plan.index("AS _rec_body")


def test_a_span_meets_ids_in_rows_of_many(spark):
    """Against the ids by hand: ties beyond one row, equal and null ids, two kinds, providers without a registration."""
    ids = [f" M{k % 2000} " for k in range(2 * IDS + 300)] + [None, None]
    prrg = strings(spark, PRRG, [("C", "MD", "9", i) for i in ids] + [("C", "MD ", "2", "other"), ("C", "MD ", "2", None), ("D", "MD", "1", None), ("C", "NP", "99", "no")])
    prpr = strings(spark, PRPR, [("P0", "C"), ("P1", "D"), ("P2", "none"), ("P3", None), ("P4", "C"), ("P4", "D")])
    spans = strings(spark, ["TAG", "CM_PRPR_ID"], [(f"s{p}", f"P{p}") for p in range(6)] + [("s0", "P0")])
    c, d, blank = [i and i.strip() for i in ids] + ["other", None], [None], [" " * 15]
    want = Counter((t, g, i) for t, g, of in [("s0", "C", c * 2), ("s1", "D", d), ("s2", "none", blank), ("s3", None, blank), ("s4", "C", c), ("s4", "D", d), ("s5", None, blank)] for i in of)
    assert Counter((r["TAG"], r["PRCR_ID"], r["elig_pcp_mdcd_id"]) for r in with_registration(spans, prpr, prrg).collect()) == want
    printed = Counter((r["TAG"], r["PRCR_ID"], r[PRINTED_ID]) for r in with_registration(spans, prpr, prrg, printed=True).collect())
    by_hand = Counter()
    for (t, g, i), n in want.items():
        by_hand[t, g, (i or " ").ljust(15)] += n
    assert printed == by_hand
    sizes = [len(r["_ids"]) for r in latest_ids(prrg).collect()]
    assert sum(sizes) == len(c + d) and max(sizes) <= IDS and len(sizes) == 5


def test_an_id_is_padded_once_a_registration(spark):
    plan = QUERIES["elig_records"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "rpad" not in plan[: plan.index("Join LeftOuter")] and "AS rec_type" in plan[: plan.index("Join LeftOuter")]


def test_delimited_spans_are_parsed_once(spark):
    plan = QUERIES["delimited_roundtrip"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan csv" in line]
    assert scans and not any("CM_ELIG_" in line for line in scans)


def test_state_ids_need_no_registration(spark):
    plan = QUERIES["state_scaffold"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2  # those of the records


def staged(spark):
    return set(os.listdir(shared_dir(spark).removeprefix("file:")))


def test_state_scaffold_stages_no_records(spark):
    before = staged(spark)
    assert QUERIES["state_scaffold"](spark, SF_SMALL).count() > 5
    assert staged(spark) == before


@pytest.mark.parametrize("held", [10**6, 0])
def test_write_extract_sorts_bodies_and_writes_all_records(spark, tmp_out, held):
    """Against the plain sort of whole records: ties beyond one chunk, copied spans, a provider of several groups, blank ids."""
    d = SF_SMALL
    elig = fx.elig(spark, d)
    elig = elig.unionByName(elig.filter(F.col("CM_PRPR_ID") == "P1")).withColumn("CM_PRPR_ID", F.when(F.col("CM_PRPR_ID").isin("P3", "P4"), "P1").otherwise(F.col("CM_PRPR_ID")))
    elig = elig.unionByName(elig.withColumn("CM_PRPR_ID", F.concat("CM_PRPR_ID", F.lit(" "))))  # the same body, another provider key
    prpr = fx.prpr(spark, d).unionByName(strings(spark, PRPR, [("P1", "BIG"), ("P1", "BIG"), ("P1", "C2"), ("P1 ", "SMALL"), ("P2 ", None), (None, "C1")]))
    ties = [("BIG", "MD", "99", f"M{k * 7919 % 1300:04d}") for k in range(1300)]
    prrg = fx.prrg(spark, d).unionByName(strings(spark, PRRG, [*ties, ("SMALL", "MD ", "1", "M0500x"), ("SMALL", "MD", "1", None)]))
    records = build_extract(fx.demo(spark, d), elig, prpr, prrg, fx.AS_OF)
    keys = [F.col(k).asc_nulls_first() for k in SORT_KEYS]
    want = [r["rec_type"] for r in records.sort(*keys).collect()]
    assert len(want) > 2600
    bodies = record_bodies(fx.demo(spark, d), elig, fx.AS_OF)
    assert bodies.count() < len(want) / 2
    for single in (True, False):
        path = f"{tmp_out}/{single}"
        assert write_extract(bodies, prpr, prrg, path, single_file=single, lines=500, held=held) == len(want)
        assert [r["rec_type"] for r in _file_lines(spark, path, 1).sort("line_no").collect()] == want
        assert (len(spark.read.text(path).inputFiles()) == 1) == single


def test_lines_are_numbered_without_a_shuffle_of_the_lines(spark, tmp_out):
    spark.range(1000).selectExpr("concat('line ', lpad(id, 4, '0')) AS value").repartitionByRange(5, "value").sortWithinPartitions("value").write.text(tmp_out)
    out = _file_lines(spark, tmp_out, 1000)
    assert [(r[0], r[1]) for r in out.sort("line_no").collect()] == [(k + 1, f"line {k:04d}") for k in range(1000)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") > plan.index("Join")  # only the blocks' counts are ordered
