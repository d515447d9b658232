"""CHANGE runs: deletes, puts, rejects, key dedupe and state invariants."""

import datetime as dt

from helpers import strings
from pyspark.sql import functions as F

from enrollspark.operators.change import STATE_COLS, apply_change
from enrollspark.sources.state import STATE_SCHEMA

ELIG_COLS = ["CM_ELIG_MEME_CK", "CM_ELIG_EFF_DT", "CM_ELIG_TERM_DT", "CM_CSPI_ID", "CM_SGSG_ID", "CM_CSCS_ID",
             "CM_MEPE_FI", "CM_PDPD_ID"]
DEMO_COLS = ["CM_DEMO_MEME_CK", "CM_ELIG_IND"]


def _state(spark, rows):
    return spark.createDataFrame(rows, STATE_SCHEMA)


def _srow(ck, eff, term, cspi="S"):
    return (f"{ck}_{eff.isoformat()}", ck, eff, term, cspi, "", "", "", "")


D = dt.date


def _sorted(df):
    return sorted(tuple(r) for r in df.select(*STATE_COLS).collect())


def test_replace_members_and_keep_others(spark):
    state = _state(
        spark,
        [
            _srow("1", D(2019, 1, 1), D(2019, 12, 31)),
            _srow("1", D(2020, 1, 1), D(2020, 12, 31)),
            _srow("2", D(2019, 1, 1), D(2019, 12, 31)),
            _srow("3", D(2019, 1, 1), D(2019, 12, 31)),
        ],
    )
    demo = strings(spark, DEMO_COLS, [("1", "Y"), ("3", "N"), ("4", "Y"), ("  ", "Y")])
    elig = strings(
        spark,
        ELIG_COLS,
        [
            ("1", "20210101", "20211231", "NEW", None, "  ", "F", "PD"),
            ("1", "20210101", "20210630", "OLDER", None, None, None, None),  # same key, earlier term
            ("3", "20210101", "20211231", "X", None, None, None, None),  # member not flagged Y
            ("4", "20210101", "20240231", "BAD", None, None, None, None),  # only span rejected
            ("  ", "20210101", "20211231", "BLANK", None, None, None, None),  # blank member key
        ],
    )
    r = apply_change(state, demo, elig)
    assert sorted(x.row_key for x in r.deleted_keys.collect()) == ["1_2019-01-01", "1_2020-01-01"]
    new = r.new_spans.collect()
    assert len(new) == 1
    n = new[0]
    assert (n.row_key, n.MEME_CK, n.MEPE_EFF_DT, n.MEPE_TERM_DT, n.CSPI_ID, n.SGSG_ID, n.CSCS_ID, n.MEPE_FI, n.PDPD_ID) == (
        "1_2021-01-01", "1", D(2021, 1, 1), D(2021, 12, 31), "NEW", "", "", "F", "PD"
    )
    reasons = sorted((x.MEME_CK, x.reason) for x in r.rejects.collect())
    assert reasons == [("", "blank member key"), ("4", "unparseable termination date")]
    after = _sorted(r.state_after)
    assert [a[0] for a in after] == ["1_2021-01-01", "2_2019-01-01", "3_2019-01-01"]


def test_apply_twice_equals_once_and_unaffected_rows_untouched(spark):
    state = _state(spark, [_srow("1", D(2019, 1, 1), D(2019, 12, 31)), _srow("2", D(2019, 1, 1), None)])
    demo = strings(spark, DEMO_COLS, [("1", "Y")])
    elig = strings(spark, ELIG_COLS, [("1", "20210101", "20211231", "A", "B", "C", "D", "E")])
    once = apply_change(state, demo, elig).state_after
    once_rows = _sorted(once)
    twice = apply_change(spark.createDataFrame(once_rows, STATE_SCHEMA), demo, elig).state_after
    assert _sorted(twice) == once_rows
    assert ("2_2019-01-01", "2", D(2019, 1, 1), None, "S", "", "", "", "") in once_rows


def test_new_member_without_old_spans(spark):
    state = _state(spark, [])
    demo = strings(spark, DEMO_COLS, [("7", "Y")])
    elig = strings(spark, ELIG_COLS, [("7", "20210101", "20211231", None, None, None, None, None)])
    r = apply_change(state, demo, elig)
    assert r.deleted_keys.count() == 0
    assert [x.row_key for x in r.state_after.collect()] == ["7_2021-01-01"]
    assert r.state_after.filter(F.col("CSPI_ID") == "").count() == 1
