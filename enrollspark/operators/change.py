"""CHANGE runs: replace the changed members' spans in the span state (JN-6..8, PRJ-13..15, SNK-2/3).

The state is a table of spans keyed by ``row_key = <member>_<yyyy-MM-dd>``.
A change run deletes every span of a replaced member and puts the member's new
spans. Here both steps are relational: the kept state is an anti-join, the new
state is ``kept ∪ new spans``; nothing is collected to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from enrollspark.functions.text import blank_to_empty, parse_ymd, row_key

STATE_COLS = [
    "row_key",
    "MEME_CK",
    "MEPE_EFF_DT",
    "MEPE_TERM_DT",
    "CSPI_ID",
    "SGSG_ID",
    "CSCS_ID",
    "MEPE_FI",
    "PDPD_ID",
]

# The span columns written to the state, source → state name.
_SPAN_VALUE_COLS = [
    ("CM_CSPI_ID", "CSPI_ID"),
    ("CM_SGSG_ID", "SGSG_ID"),
    ("CM_CSCS_ID", "CSCS_ID"),
    ("CM_MEPE_FI", "MEPE_FI"),
    ("CM_PDPD_ID", "PDPD_ID"),
]

POLICIES = 100_000  # of a member that one task joins with its spans

REJECT_BLANK_MEMBER = "blank member key"
REJECT_BAD_EFF = "unparseable effective date"
REJECT_BAD_TERM = "unparseable termination date"


def member_timeline(demo: DataFrame, elig: DataFrame, cob: DataFrame | None = None, policies: int = POLICIES) -> DataFrame:
    """DEMO ⋈ ELIG on the member key only (JN-6): every member row with every span of the member;
    with ``cob``, also ⟕ COB on the member (JN-7), one row per COB policy of the member.

    A member with more than ``policies`` policies is hot: its policies are dealt to parts by
    the hash of the whole row, and its member rows and spans go to every part, so that
    no task holds all of them; other members have one part. A null member key meets nothing.
    The join has as many tasks as a shuffle: AQE would merge them by the size of what is
    shuffled, which is far below that of the rows sorted and joined, and they would spill.

    No COB column reaches the state, so the state update leaves COB out (the
    join would only repeat rows whose keys are deduplicated anyway) and reads
    ``eligible_spans`` instead of this product.
    """
    e = elig.drop("RECORD_TYPE")
    t = demo.join(e, demo["CM_DEMO_MEME_CK"] == e["CM_ELIG_MEME_CK"], "inner")
    if cob is None:
        return t
    columns = [*t.columns, *(c for c in cob.columns if c != "RECORD_TYPE")]
    # a row for each hot member: at most the policies / ``policies``
    hot = cob.groupBy(F.col("CM_COB_MEME_CK").alias("_hot")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > policies)
    hot = hot.select("_hot", F.ceil(F.col("_n") / policies).cast("int").alias("_parts"))
    c = cob.drop("RECORD_TYPE").join(hot, F.col("CM_COB_MEME_CK") == F.col("_hot"), "left")
    c = c.withColumn("_part", F.pmod(F.xxhash64(*[x for x in cob.columns if x != "RECORD_TYPE"]), F.coalesce("_parts", F.lit(1))).cast("int"))
    t = t.join(hot, F.col("CM_ELIG_MEME_CK") == F.col("_hot"), "left")
    t = t.withColumn("_at", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).withColumnRenamed("_parts", "_of")
    tasks = int(demo.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = t.repartition(tasks, "CM_ELIG_MEME_CK", "_at")
    c = c.filter("CM_COB_MEME_CK IS NOT NULL").drop("_hot", "_parts").repartition(tasks, "CM_COB_MEME_CK", "_part")
    out = t.join(c, (F.col("CM_ELIG_MEME_CK") == F.col("CM_COB_MEME_CK")) & (F.col("_at") == F.col("_part")), "left")
    # a hot member has policies, so a part that got none of them has no row
    return out.filter(F.col("_of").isNull() | F.col("CM_COB_MEME_CK").isNotNull()).select(*columns)


def with_distinct_spans(demo: DataFrame, elig: DataFrame, name: str) -> DataFrame:
    """DEMO with the number of its member's distinct spans (group, effective and termination date; null
    is a value as any other) as column ``name``, null for a member without spans.

    Every policy of a member meets all its spans (``member_timeline``), so this is also the number of
    distinct spans in the timeline rows of a member and policy, without a shuffle of these rows.
    """
    span = F.struct("CM_ELIG_GRGR_CK", "CM_ELIG_EFF_DT", "CM_ELIG_TERM_DT")
    counts = elig.groupBy(F.col("CM_ELIG_MEME_CK").alias("_of_member")).agg(F.count_distinct(span).alias(name))
    return demo.join(counts, F.col("CM_DEMO_MEME_CK") == F.col("_of_member"), "left").drop("_of_member")


def timeline_counts(demo: DataFrame, elig: DataFrame, cob: DataFrame) -> DataFrame:
    """Per member what ``member_timeline`` would hold: its rows, those with a COB policy, the first and last span.

    Every side is reduced to a row for each member first; the product of member
    rows, spans and policies is counted, never formed.
    """
    d = demo.groupBy("CM_DEMO_MEME_CK").agg(F.count(F.lit(1)).alias("_d"))
    e = elig.groupBy("CM_ELIG_MEME_CK").agg(
        F.count(F.lit(1)).alias("_e"), F.min("CM_ELIG_EFF_DT").alias("first_eff"), F.max("CM_ELIG_EFF_DT").alias("last_eff")
    )
    c = cob.groupBy("CM_COB_MEME_CK").agg(F.count(F.lit(1)).alias("_c"), F.count("CM_COB_POLICY_ID").alias("_p"))
    j = d.join(e, F.col("CM_DEMO_MEME_CK") == F.col("CM_ELIG_MEME_CK")).join(c, F.col("CM_DEMO_MEME_CK") == F.col("CM_COB_MEME_CK"), "left")
    rows = F.col("_d") * F.col("_e")
    return j.select(
        "CM_DEMO_MEME_CK",
        (rows * F.coalesce("_c", F.lit(1))).alias("timeline_rows"),
        (rows * F.coalesce("_p", F.lit(0))).alias("cob_rows"),
        "first_eff",
        "last_eff",
    )


def with_composite_keys(timeline: DataFrame) -> DataFrame:
    """Adds the six group/plan composite keys (null when any part is null) and two aliases."""
    g = F.col("CM_ELIG_GRGR_ID")
    cspi, cscs, sgsg = F.col("CM_CSPI_ID"), F.col("CM_CSCS_ID"), F.col("CM_SGSG_ID")
    return timeline.select(
        "*",
        F.concat(g, cspi).alias("GRGR_ID_CSPI_ID"),
        F.concat(g, cscs, sgsg).alias("GRGR_ID_CSCS_ID_SGSG_ID"),
        F.concat(g, cspi, cscs).alias("GRGR_ID_CSPI_ID_CSCS_ID"),
        F.concat(g, cspi, sgsg).alias("GRGR_ID_CSPI_ID_SGSG_ID"),
        F.concat(g, sgsg).alias("GRGR_ID_SGSG_ID"),
        F.concat(g, cscs).alias("GRGR_ID_CSCS_ID"),
        F.col("CM_ELIG_SBSB_ID").alias("SBSB_ID"),
        F.col("CM_MEME_MEDCD_NO").alias("MEME_MEDCD_NO"),
    )


def eligible_spans(demo: DataFrame, elig: DataFrame) -> DataFrame:
    """ELIG rows of members with a DEMO row flagged ``'Y'`` (left semi join on the member).

    The state columns come from ELIG alone and the member key is equal on both
    sides, so every timeline row of one span gives the same state row: a semi
    join yields the spans once, without forming member rows × spans.
    """
    m = demo.filter(F.col("CM_ELIG_IND") == "Y").select(F.col("CM_DEMO_MEME_CK").alias("_m"))
    return elig.join(m, elig["CM_ELIG_MEME_CK"] == m["_m"], "left_semi")


def normalised_spans(spans: DataFrame) -> DataFrame:
    """The spans (output of ``eligible_spans``) as state rows, with the reason why a row can't be stored, or null."""
    return spans.select(
        blank_to_empty("CM_ELIG_MEME_CK").alias("MEME_CK"),
        blank_to_empty("CM_ELIG_EFF_DT").alias("_eff"),
        blank_to_empty("CM_ELIG_TERM_DT").alias("_term"),
        *[blank_to_empty(src).alias(dst) for src, dst in _SPAN_VALUE_COLS],
    ).select(
        row_key("MEME_CK", "_eff").alias("row_key"),
        "MEME_CK",
        parse_ymd("_eff").alias("MEPE_EFF_DT"),
        parse_ymd("_term").alias("MEPE_TERM_DT"),
        *[dst for _, dst in _SPAN_VALUE_COLS],
        F.when(F.col("MEME_CK") == "", F.lit(REJECT_BLANK_MEMBER))
        .when(parse_ymd("_eff").isNull(), F.lit(REJECT_BAD_EFF))
        .when(parse_ymd("_term").isNull(), F.lit(REJECT_BAD_TERM))
        .alias("reason"),
        F.col("_eff").alias("EFF_RAW"),
        F.col("_term").alias("TERM_RAW"),
    )


def span_rejects(spans: DataFrame) -> DataFrame:
    """Spans (output of ``normalised_spans``) that cannot be stored: blank member,
    unparseable effective or termination date; with the reason and raw dates."""
    return spans.filter(F.col("reason").isNotNull())


def new_spans(spans: DataFrame) -> DataFrame:
    """State rows to put (output of ``normalised_spans``): one per row key.

    When several spans map to one key the store would keep one of them; here it
    is the latest termination date, then the greatest other values, so reruns
    give the same state. ``row_number() == 1`` is planned with a map-side
    window group limit, so repeated keys are cut before the shuffle.
    """
    good = spans.filter(F.col("reason").isNull()).select(*STATE_COLS)
    order = [F.col(c).desc_nulls_last() for c in ["MEPE_TERM_DT", *[dst for _, dst in _SPAN_VALUE_COLS], "MEME_CK", "MEPE_EFF_DT"]]
    w = Window.partitionBy("row_key").orderBy(*order)
    return good.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1).drop("_n")


def replaced_members(spans: DataFrame) -> DataFrame:
    """Members (output of ``normalised_spans``) that receive at least one span, one row for each span.

    Keeping one span of each key never drops a member, so the members come from the
    spans as they are: a semi or anti join needs neither a window nor a distinct,
    and Spark can split a hot member of the state.
    """
    return spans.filter(F.col("reason").isNull()).select("MEME_CK")


@dataclass(frozen=True)
class ChangeResult:
    deleted_keys: DataFrame
    kept: DataFrame
    new_spans: DataFrame
    rejects: DataFrame
    state_after: DataFrame


def apply_change(state: DataFrame, demo: DataFrame, elig: DataFrame) -> ChangeResult:
    """Replace the spans of changed members in ``state`` (lazy; nothing is written here)."""
    return replace_spans(state, normalised_spans(eligible_spans(demo, elig)))


def replace_spans(state: DataFrame, candidates: DataFrame) -> ChangeResult:
    """Put ``candidates`` (output of ``normalised_spans``) into ``state``.

    ``deleted_keys``  row keys of the state rows removed;
    ``kept``          state rows of members not replaced;
    ``new_spans``     rows put, one per key;
    ``rejects``       new spans that could not be stored, with a reason;
    ``state_after``   ``kept ∪ new_spans``, the next snapshot.
    """
    spans = new_spans(candidates)
    members = replaced_members(candidates).withColumnRenamed("MEME_CK", "_member")
    st = state.select(*STATE_COLS)
    deleted = st.join(members, F.col("MEME_CK") == F.col("_member"), "left_semi")
    kept = st.join(members, F.col("MEME_CK") == F.col("_member"), "left_anti")
    return ChangeResult(
        deleted_keys=deleted.select("row_key"),
        kept=kept,
        new_spans=spans,
        rejects=span_rejects(candidates),
        state_after=kept.unionByName(spans),
    )
