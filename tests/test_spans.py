"""Active spans and the two span joins: bounds, bad dates, twins, fan-out."""

import datetime as dt

from helpers import DEMO_MIN, ELIG_MIN, strings

from enrollspark.operators.spans import active_members, active_spans, span_detail

AS_OF = dt.date(2020, 6, 15)


def test_bounds_are_inclusive_and_bad_dates_drop(spark):
    elig = strings(
        spark,
        ELIG_MIN,
        [
            ("1", "G", "20200615", "20200615", "Y", "A", "same-day"),
            ("1", "G", "20200101", "20200614", "Y", "A", "ended"),
            ("1", "G", "20200616", "20201231", "Y", "A", "future"),
            ("1", "G", "20200101", "20240231", "Y", "A", "impossible-term"),
            ("1", "G", "20200101", "", "Y", "A", "blank-term"),
            ("1", "G", " 20200101", "20201231", "Y", "A", "leading-blank"),
            ("1", "G", "20200101", "20201231", "y", "A", "lower-y"),
            ("1", "G", "20200101", "20201231", "Y ", "A", "untrimmed-y"),
            ("1", "G", "20200101", "20201231", "Y", "A", "ok"),
        ],
    )
    got = sorted(r.TAG for r in active_spans(elig, AS_OF).collect())
    assert got == ["ok", "same-day"]


def test_span_detail_keeps_n_twin_and_fans_out_like_the_join(spark):
    demo = strings(spark, DEMO_MIN, [("1", "G", "d1"), ("1", "G", "d2"), ("2", "G", "d3")])
    elig = strings(
        spark,
        ELIG_MIN,
        [
            ("1", "G", "20200101", "20201231", "Y", "A", "y1"),
            ("1", "G", "20200101", "20201231", "Y", "A", "y2"),
            ("1", "G", "20200101", "20201231", "N", "A", "twin"),
            ("1", "H", "20200101", "20201231", "Y", "A", "other-group"),
            ("2", "G", "20200101", "20201231", "N", "A", "only-n"),
        ],
    )
    members = active_members(demo, elig, AS_OF)
    assert members.count() == 4  # 2 member rows x 2 active spans
    detail = span_detail(elig, demo, AS_OF)
    # each of y1, y2, twin matches the 4 member rows of its key
    counts = {r.TAG: r["count"] for r in detail.groupBy("TAG").count().collect()}
    assert counts == {"y1": 4, "y2": 4, "twin": 4}
    plain = elig.alias("e").join(
        members.alias("m"),
        [
            elig.CM_ELIG_MEME_CK == members.CM_DEMO_MEME_CK,
            elig.CM_ELIG_GRGR_CK == members.CM_DEMO_GRGR_CK,
            elig.CM_ELIG_EFF_DT == members.CM_ELIG_EFF_DT,
            elig.CM_ELIG_TERM_DT == members.CM_ELIG_TERM_DT,
        ],
    )
    assert plain.count() == detail.count()


def test_repeat_rows_is_exact_across_chunks(spark):
    from pyspark.sql import functions as F

    from enrollspark.operators.spans import repeat_rows

    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 10), ("d", 23)], "k string, n long")
    got = {r.k: r["count"] for r in repeat_rows(df, "n", chunk=5).groupBy("k").count().collect()}
    assert got == {"a": 1, "b": 7, "c": 10, "d": 23}
    assert repeat_rows(df, "n", chunk=5).columns == ["k"]
    big = spark.createDataFrame([("x", 2_500_001)], "k string, n long")
    assert repeat_rows(big, "n").agg(F.count("*")).first()[0] == 2_500_001
