"""Eligibility spans: which members are active on the run date (FLT-1/2, JN-1, JN-2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrollspark.functions.text import parse_ymd

MEMBER, GROUP, EFF, TERM = "CM_ELIG_MEME_CK", "CM_ELIG_GRGR_CK", "CM_ELIG_EFF_DT", "CM_ELIG_TERM_DT"
SPAN_KEYS = [MEMBER, GROUP, EFF, TERM]
EFF_DATE, TERM_DATE = "EFF_DATE", "TERM_DATE"
REPEAT_CHUNK = 10_000
SALTS = 8  # parts that a member's span keys are dealt to


def repeat_rows(df: DataFrame, times: str, chunk: int = REPEAT_CHUNK) -> DataFrame:
    """Each row ``times`` times (a long column ≥ 1), then ``times`` dropped.

    Two generator levels — chunks, then rows within a chunk — keep every
    generated array at most ``chunk`` long however large the count is.
    """
    n = F.col(times)
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk).cast("long"))
    out = df.withColumn("_chunk", F.explode(chunks))
    size = F.least(F.lit(chunk).cast("long"), n - F.col("_chunk") * chunk).cast("int")
    return out.withColumn("_rep", F.explode(F.array_repeat(F.lit(True), size))).drop(times, "_chunk", "_rep")


def typed_spans(elig: DataFrame) -> DataFrame:
    """ELIG with its dates parsed once, as the DATE columns EFF_DATE and TERM_DATE; a blank or impossible date is null.

    Written to Parquet (``write_spans``), the run-date test of ``current_spans`` on these
    columns is answered from row-group statistics before any row is read.
    """
    return elig.select("*", parse_ymd(EFF).alias(EFF_DATE), parse_ymd(TERM).alias(TERM_DATE))


def current_spans(elig: DataFrame, as_of: dt.date) -> DataFrame:
    """Spans whose dates contain ``as_of`` (both ends inclusive), whatever their indicator.

    A blank or impossible date gives null and drops the span. Only these spans
    can share all four keys with an active span, so the detail join reads them
    instead of the whole file. Typed dates (``typed_spans``) are used where ``elig`` has
    them, and dropped.
    """
    day = F.lit(as_of)
    if EFF_DATE in elig.columns and TERM_DATE in elig.columns:
        return elig.filter((F.col(EFF_DATE) <= day) & (F.col(TERM_DATE) >= day)).drop(EFF_DATE, TERM_DATE)
    return elig.filter((parse_ymd(EFF) <= day) & (parse_ymd(TERM) >= day))


def active_spans(elig: DataFrame, as_of: dt.date) -> DataFrame:
    """Spans flagged eligible (``'Y'``, untrimmed) that contain ``as_of``."""
    return current_spans(elig.filter(F.col("CM_MEPE_ELIG_IND") == "Y"), as_of)


def active_members(demo: DataFrame, elig: DataFrame, as_of: dt.date) -> DataFrame:
    """DEMO ⋈ active spans on member and group: one row per member row and active span.

    Returns every DEMO column plus the span's dates and aid code.
    """
    spans = active_spans(elig, as_of).select(
        F.col(MEMBER).alias("_ck"),
        F.col(GROUP).alias("_gk"),
        EFF,
        TERM,
        "CM_MECD_MCTR_AIDC",
    )
    j = demo.join(
        spans,
        (demo["CM_DEMO_MEME_CK"] == spans["_ck"]) & (demo["CM_DEMO_GRGR_CK"] == spans["_gk"]),
        "inner",
    )
    return j.drop("_ck", "_gk")


def span_multiplicity(demo: DataFrame, elig: DataFrame, as_of: dt.date) -> DataFrame:
    """How many active-member rows (output of ``active_members``) carry each span key
    (member, group, eff, term): DEMO rows of the member and group × active spans with the key.

    Both factors are aggregates with map-side partial counts, so neither the
    member × span product nor a hot key's rows cross the shuffle. The span keys of a
    member are dealt to SALTS parts by their dates and its one count goes to each
    part, so a member with very many spans isn't one task's.
    """
    d = demo.groupBy(F.col("CM_DEMO_MEME_CK").alias("_ck"), F.col("CM_DEMO_GRGR_CK").alias("_gk")).agg(
        F.count(F.lit(1)).alias("_d")
    )
    a = active_spans(elig, as_of).groupBy(*SPAN_KEYS).agg(F.count(F.lit(1)).alias("_a"))
    a = a.withColumn("_part", F.pmod(F.xxhash64(EFF, TERM), F.lit(SALTS)).cast("int"))
    d = d.withColumn("_dpart", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    m = a.join(d, (a[MEMBER] == d["_ck"]) & (a[GROUP] == d["_gk"]) & (a["_part"] == d["_dpart"]), "inner")
    return m.select(*SPAN_KEYS, (F.col("_a") * F.col("_d")).alias("_n"))


def span_detail(elig: DataFrame, demo: DataFrame, as_of: dt.date) -> DataFrame:
    """ELIG ⋈ active members (``active_members(demo, elig, as_of)``) on all four span keys (JN-2).

    ELIG is not filtered on the indicator, so an ``'N'`` twin of an active span
    is kept. Each ELIG row appears once per matching active-member row, as in
    the plain join; the member side is reduced to one count per key and the
    rows are repeated after the join.
    """
    counts = span_multiplicity(demo, elig, as_of)
    return repeat_rows(current_spans(elig, as_of).join(counts, SPAN_KEYS, "inner"), "_n")
