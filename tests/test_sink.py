"""Sorted fixed-width text output: one file or ordered parts."""

import glob

from pyspark.sql import functions as F

from conftest import SF_SMALL
from enrollspark.plans.extract import build_extract, write_records
from enrollspark.sources import fixtures as fx


def _lines(path):
    path = path[len("file:"):] if path.startswith("file:") else path
    out = []
    for p in sorted(glob.glob(f"{path}/part-*")):
        with open(p, encoding="utf-8") as f:
            out.extend(line.rstrip("\n") for line in f)
    return out


def _expected(spark, recs):
    rows = recs.select("SBSB_ID", "REC_NUM", "EFF_DT", "rec_type").collect()
    rows.sort(key=lambda r: (r.SBSB_ID is not None, r.SBSB_ID or "", r.REC_NUM, r.EFF_DT is not None, r.EFF_DT or "", r.rec_type))
    return [r.rec_type for r in rows]


def test_single_file_and_parts_are_in_order(spark, tmp_out):
    d = SF_SMALL
    recs = build_extract(fx.demo(spark, d), fx.elig(spark, d), fx.prpr(spark, d), fx.prrg(spark, d), fx.AS_OF)
    expected = _expected(spark, recs)
    n1 = write_records(recs, f"{tmp_out}/one", single_file=True)
    assert n1 == len(expected) == 332
    assert len(glob.glob(f"{tmp_out.removeprefix('file:')}/one/part-*")) == 1
    assert _lines(f"{tmp_out}/one") == expected
    n2 = write_records(recs, f"{tmp_out}/parts", single_file=False, parts=4)
    assert n2 == n1
    assert _lines(f"{tmp_out}/parts") == expected


def test_record_lengths(spark):
    d = SF_SMALL
    recs = build_extract(fx.demo(spark, d), fx.elig(spark, d), fx.prpr(spark, d), fx.prrg(spark, d), fx.AS_OF)
    lens = {(r.REC_NUM, r.l): r["count"] for r in recs.groupBy("REC_NUM", F.length("rec_type").alias("l")).count().collect()}
    assert lens == {(1, 990): 84, (1, 1000): 76, (2, 1000): 172}
    strict = build_extract(
        fx.demo(spark, d), fx.elig(spark, d), fx.prpr(spark, d), fx.prrg(spark, d), fx.AS_OF, strict_width=True
    )
    assert strict.filter(F.length("rec_type") != 1000).count() == 0


def test_empty_extract_writes_an_empty_file(spark, tmp_out):
    import datetime as dt

    d = SF_SMALL
    # a run date before every span: no member is active
    recs = build_extract(fx.demo(spark, d), fx.elig(spark, d), fx.prpr(spark, d), fx.prrg(spark, d), dt.date(1900, 1, 1))
    assert write_records(recs, f"{tmp_out}/empty", single_file=True) == 0
    assert _lines(f"{tmp_out}/empty") == []
    assert write_records(recs, f"{tmp_out}/empty_parts", single_file=False) == 0
