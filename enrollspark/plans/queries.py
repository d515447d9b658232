"""Named queries over the test tables: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame; the entities come from
:mod:`enrollspark.sources.fixtures`. :mod:`enrollspark.oracle` holds the DuckDB
twin of each, with the same column names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from enrollspark.operators import change as ch
from enrollspark.operators import optional as opt
from enrollspark.operators.providers import latest_registration, with_registration
from enrollspark.operators.records import cob_records, demo_records, elig_body, elig_records, with_body
from enrollspark.operators.spans import active_members, current_spans, span_detail
from enrollspark.plans.extract import build_extract, extract_parts, publish_change, record_bodies, stage, write_extract
from enrollspark.plans.views import extract_views
from enrollspark.session import scratch_path
from enrollspark.sources import fixtures as fx
from enrollspark.sources.delimited import SEPARATOR, input_path, layout_path, layout_schema, read_checked, read_input, write_delimited
from enrollspark.sources.joined import ARCHIVE, archive_path
from enrollspark.sources.state import read_state, write_state
from enrollspark.sources.tables import read_slice, write_prepared, write_slice, write_spans

Query = Callable[[SparkSession, str], DataFrame]

SLICES = ("01", "1", "ALL")
FILE_LINES = 1_000_000  # of a compressed text file, which one task reads


def _members(spark: SparkSession, d: str) -> DataFrame:
    return active_members(fx.demo(spark, d), fx.elig(spark, d), fx.AS_OF)


def _detail(spark: SparkSession, d: str) -> DataFrame:
    return span_detail(fx.elig(spark, d), fx.demo(spark, d), fx.AS_OF)


def _with_reg(spark: SparkSession, d: str) -> DataFrame:
    return with_registration(_detail(spark, d), fx.prpr(spark, d), fx.prrg(spark, d))


def _extract(spark: SparkSession, d: str) -> DataFrame:
    return build_extract(fx.demo(spark, d), fx.elig(spark, d), fx.prpr(spark, d), fx.prrg(spark, d), fx.AS_OF)


def _cob_top(spark: SparkSession, d: str) -> DataFrame:
    return opt.cob_with_members(opt.cob_top(fx.cob(spark, d)), fx.demo(spark, d))


def _timeline(spark: SparkSession, d: str) -> DataFrame:
    return ch.member_timeline(fx.demo(spark, d), fx.elig(spark, d))


def _change(spark: SparkSession, d: str) -> ch.ChangeResult:
    return ch.apply_change(fx.span_state(spark, d), fx.change_demo(spark, d), fx.change_elig(spark, d))


def _maintenance(spark: SparkSession, d: str) -> DataFrame:
    m = opt.maintenance_code(fx.demo(spark, d), fx.elig(spark, d), fx.span_state(spark, d), fx.AS_OF)
    return m.select(
        "CM_DEMO_MEME_CK",
        "CM_DEMO_GRGR_CK",
        "CM_MECD_MCTR_AIDC",
        "CM_ELIG_EFF_DT_MAX",
        "CM_ELIG_TERM_DT_MAX",
        "elig_maint_typ_cd",
    )


def active_members_q(spark: SparkSession, d: str) -> DataFrame:
    return _members(spark, d).select(
        "CM_DEMO_MEME_CK",
        "CM_DEMO_GRGR_CK",
        "CM_DEMO_SBSB_ID",
        "CM_ELIG_IND",
        "CM_ELIG_EFF_DT",
        "CM_ELIG_TERM_DT",
        "CM_MECD_MCTR_AIDC",
    )


def _detail_columns(detail: DataFrame) -> DataFrame:
    return detail.select(
        "CM_ELIG_MEME_CK",
        "CM_ELIG_GRGR_CK",
        "CM_ELIG_EFF_DT",
        "CM_ELIG_TERM_DT",
        "CM_MEPE_ELIG_IND",
        "CM_ELIG_SBSB_ID",
        "CM_PRPR_ID",
    )


def span_detail_q(spark: SparkSession, d: str) -> DataFrame:
    return _detail_columns(_detail(spark, d))


def extract_by_state_q(spark: SparkSession, d: str) -> DataFrame:
    return _extract(spark, d).groupBy("STATE_ID").agg(
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(F.col("REC_NUM") == 1, True)).alias("member_records"),
        F.count(F.when(F.col("REC_NUM") == 2, True)).alias("span_records"),
    )


def delimited_roundtrip_q(spark: SparkSession, d: str) -> DataFrame:
    """Writes DEMO, ELIG and COB as pipe-delimited files with layout headers under the shared
    folder (compressed), reads them back through the layouts, and runs the extract with COB on them. The spans of the
    run date are parsed once and staged, as in ``run_extract``."""
    root = scratch_path(spark, "delimited")
    staging, layouts = f"{root}/staging", f"{root}/layouts"
    vendor, mode, state = "VENDOR", "FULL", "ALL"
    for kind, df in _inputs(spark, d).items():
        write_delimited(df, input_path(staging, vendor, mode, state, kind), layout_path(layouts, kind), compression="gzip", lines=FILE_LINES)
    demo, elig, cob = (read_input(spark, layouts, staging, vendor, mode, state, k) for k in ("DEMO", "ELIG", "COB"))
    spans = stage(current_spans(elig, fx.AS_OF), f"{root}/spans")
    return build_extract(demo, spans, fx.prpr(spark, d), fx.prrg(spark, d), fx.AS_OF, cob=cob)


def _inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {"DEMO": fx.demo(spark, d), "ELIG": fx.elig(spark, d), "COB": fx.cob(spark, d)}


def table_slice_roundtrip_q(spark: SparkSession, d: str) -> DataFrame:
    """Writes each input table in three slices whose names look alike (``01``, ``1``, ``ALL``), by member,
    and reads each back, and one that isn't there: rows and distinct members of each."""
    out = None
    for kind, (df, key) in {
        "DEMO": (fx.demo(spark, d), "CM_DEMO_MEME_CK"),
        "ELIG": (fx.elig(spark, d), "CM_ELIG_MEME_CK"),
        "COB": (fx.cob(spark, d), "CM_COB_MEME_CK"),
    }.items():
        root = scratch_path(spark, f"slices-{kind}")
        for rest, state in enumerate(SLICES):
            write_slice(df.filter(F.col(key).cast("long") % len(SLICES) == rest), root, "VENDOR", "FULL", state)
        for state in (*SLICES, "none"):
            back = read_slice(spark, root, "VENDOR", "FULL", state)
            counts = back.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("members"), F.sum(F.col(key).cast("long")).alias("member_sum"))
            counts = counts.select(F.lit(kind).alias("kind"), F.lit(state).alias("state"), "rows", "members", "member_sum")
            out = counts if out is None else out.unionByName(counts)
    return out


def _file_lines(spark: SparkSession, path: str, rows: int) -> DataFrame:
    """The lines of a text folder, numbered in file order, with the count that the write observed.

    A block's lines are read in order by one task, so a line's place is its row id less the
    block's first; the lines themselves aren't shuffled. Both scans are planned alike; were one
    not, a block's first or last place would be impossible and the query fail.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("rec_type"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    # a row for each block of a file
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", "n", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    out = lines.join(F.broadcast(starts), ["file", "block"])
    here = F.col("at") - F.col("first")
    checked = F.when((here >= 0) & (here < F.col("n")), here).otherwise(F.raise_error(F.lit("the files were read in two ways")).cast("long"))
    return out.select((F.col("start") + checked + 1).alias("line_no"), "rec_type", F.lit(rows).cast("long").alias("observed_count"))


def _write_extract(spark: SparkSession, d: str, path: str, single_file: bool = False) -> int:
    bodies = record_bodies(fx.demo(spark, d), fx.elig(spark, d), fx.AS_OF)
    return write_extract(bodies, fx.prpr(spark, d), fx.prrg(spark, d), path, single_file=single_file, compression="lz4")


def extract_file_lines_q(spark: SparkSession, d: str) -> DataFrame:
    """Writes the extract in ordered parts, reads the files back and numbers their lines in file order;
    with the count that the write observed."""
    path = scratch_path(spark, "extract")
    return _file_lines(spark, path, _write_extract(spark, d, path))


def extract_one_file_lines_q(spark: SparkSession, d: str) -> DataFrame:
    """Writes the extract as one file, reads it back, part by part, with its line numbers and the number of files."""
    path = f"{scratch_path(spark, 'extract-one')}{ARCHIVE}"
    rows = _write_extract(spark, d, path, single_file=True)
    lines = _file_lines(spark, archive_path(spark, path), rows)
    return lines.withColumn("files", F.lit(len(spark.read.text(path).inputFiles())).cast("long"))


def state_snapshot_roundtrip_q(spark: SparkSession, d: str) -> DataFrame:
    """Writes the prior state, replaces the changed members' spans in it, and reads the state."""
    root = scratch_path(spark, "state")
    write_state(fx.span_state(spark, d), root)
    publish_change(spark, root, fx.change_demo(spark, d), fx.change_elig(spark, d))
    return read_state(spark, root)


def sql_views_q(spark: SparkSession, d: str) -> DataFrame:
    """SQL over the run's views: by state and kind of record, how many records and subscribers, and the members, spans and registered spans behind them."""
    prefix = f"v{uuid.uuid4().hex[:8]}_"  # queries may run side by side in one session
    with extract_views(spark, fx.demo(spark, d), fx.elig(spark, d), fx.prpr(spark, d), fx.prrg(spark, d), fx.AS_OF, fx.cob(spark, d), prefix=prefix) as sql:
        return sql(
            f"""
            WITH m AS (SELECT substr(CM_DEMO_GRGR_ID, 1, 2) AS STATE_ID, count(*) AS members FROM {prefix}members GROUP BY 1),
            s AS (
              SELECT substr(CM_GRGR_ID, 1, 2) AS STATE_ID, count(*) AS spans, count_if(trim(elig_pcp_mdcd_id) <> '') AS registered
              FROM {prefix}spans GROUP BY 1
            ), r AS (
              SELECT STATE_ID, REC_NUM, count(*) AS records, count(DISTINCT SBSB_ID) AS subscribers FROM {prefix}records GROUP BY ALL
            )
            SELECT r.STATE_ID, r.REC_NUM, records, subscribers, coalesce(members, 0) AS members, coalesce(spans, 0) AS spans, coalesce(registered, 0) AS registered
            FROM r LEFT JOIN m ON m.STATE_ID <=> r.STATE_ID LEFT JOIN s ON s.STATE_ID <=> r.STATE_ID
            """
        )


def typed_span_detail_q(spark: SparkSession, d: str) -> DataFrame:
    """The span detail from ELIG written once with typed, sorted dates, whose run-date test the scan answers from file statistics."""
    spans = write_spans(fx.elig(spark, d), scratch_path(spark, "typed-spans"))
    return _detail_columns(span_detail(spans, fx.demo(spark, d), fx.AS_OF))


def malformed_lines_q(spark: SparkSession, d: str) -> DataFrame:
    """Writes DEMO, ELIG and COB with some lines cut after the member's key columns and some with
    a surplus field, reads them back counting, and adds the rows that came through: lines,
    short and surplus ones, rows and distinct last-column values by kind."""
    out = None
    for kind, (key, df) in {
        "DEMO": ("CM_DEMO_MEME_CK", fx.demo(spark, d)),
        "ELIG": ("CM_ELIG_MEME_CK", fx.elig(spark, d)),
        "COB": ("CM_COB_MEME_CK", fx.cob(spark, d)),
    }.items():
        root = scratch_path(spark, f"malformed-{kind}")
        # cut lines end before the last column, surplus ones have a field more
        n = F.col(key).cast("long")
        line = F.concat_ws(SEPARATOR, *[F.coalesce(F.col(c), F.lit("")) for c in df.columns])
        short = F.concat_ws(SEPARATOR, *[F.coalesce(F.col(c), F.lit("")) for c in df.columns[:-1]])
        text = F.when(n % 7 == 3, short).when(n % 11 == 5, F.concat(line, F.lit(f"{SEPARATOR}surplus"))).otherwise(line)
        df.select(text.alias("value")).write.option("compression", "lz4").option("maxRecordsPerFile", FILE_LINES).text(f"{root}/data")
        write_delimited(df.limit(0), f"{root}/none", f"{root}/layout")
        obs = Observation(kind)
        back = read_checked(spark, f"{root}/data", layout_schema(spark, f"{root}/layout"), obs)
        rows = back.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.trim(df.columns[-1]) != "", True)).alias("last_filled"), F.sum(F.col(key).cast("long")).alias("member_sum"))
        rows = stage(rows, f"{root}/rows")
        counts = obs.get
        rows = rows.select(F.lit(kind).alias("kind"), *[F.lit(int(counts[m])).cast("long").alias(m) for m in ("lines", "short", "surplus")], "rows", "last_filled", "member_sum")
        out = rows if out is None else out.unionByName(rows)
    return out


def prepared_joins_q(spark: SparkSession, d: str, buckets: int = 16) -> DataFrame:
    """DEMO, ELIG and the state saved in buckets by their join keys; by state of the group, the rows of the
    three joins that need no exchange then: active members (JN-1), the timeline (JN-6) and the state that a change keeps (JN-8)."""
    demo, elig, state = prepared_tables(spark, d, buckets)
    changed = spark.read.table(elig["member"]).filter(F.col("CM_ELIG_MEME_CK").cast("long") % 4 == 1).select(F.col("CM_ELIG_MEME_CK").alias("_member"))
    members = active_members(spark.read.table(demo["span"]), spark.read.table(elig["span"]), fx.AS_OF)
    timeline = ch.member_timeline(spark.read.table(demo["member"]), spark.read.table(elig["member"]))
    kept = spark.read.table(state["member"]).join(changed, F.col("MEME_CK") == F.col("_member"), "left_anti")
    rows = [("JN-1", members, "CM_DEMO_MEME_CK"), ("JN-6", timeline, "CM_DEMO_MEME_CK"), ("JN-8", kept, "MEME_CK")]
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("members"), F.sum(F.col(key).cast("long")).alias("member_sum")).select(F.lit(name).alias("join"), "*")
        for name, df, key in rows
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def prepared_tables(spark: SparkSession, d: str, buckets: int) -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """The catalog names of DEMO, ELIG and the state, bucketed by the member (``member``) and, DEMO and ELIG, by member and group (``span``)."""
    tag = uuid.uuid4().hex[:12]
    demo, elig, state = fx.demo(spark, d), fx.elig(spark, d), fx.span_state(spark, d)
    plans = {
        "demo": {"member": (demo, ["CM_DEMO_MEME_CK"]), "span": (demo, ["CM_DEMO_MEME_CK", "CM_DEMO_GRGR_CK"])},
        "elig": {"member": (elig, ["CM_ELIG_MEME_CK"]), "span": (elig, ["CM_ELIG_MEME_CK", "CM_ELIG_GRGR_CK"])},
        "state": {"member": (state, ["MEME_CK"])},
    }
    out = []
    for what, ways in plans.items():
        names = {}
        for way, (df, keys) in ways.items():
            names[way] = f"prepared_{what}_{way}_{tag}"
            write_prepared(df, names[way], keys, buckets, scratch_path(spark, f"prepared-{what}-{way}"))
        out.append(names)
    return tuple(out)


def catalog_registration_q(spark: SparkSession, d: str) -> DataFrame:
    """Saves providers and registrations as catalog tables in the shared folder and joins them by table name."""
    tag = uuid.uuid4().hex[:12]
    names = {}
    for name, df in (("prpr", fx.prpr(spark, d)), ("prrg", fx.prrg(spark, d))):
        names[name] = f"{name}_{tag}"
        df.write.option("path", scratch_path(spark, name)).saveAsTable(names[name])
    return with_registration(_detail(spark, d), spark.read.table(names["prpr"]), spark.read.table(names["prrg"])).select(
        "CM_ELIG_SBSB_ID", "CM_ELIG_EFF_DT", "CM_PRPR_ID", "PRCR_ID", "elig_pcp_mdcd_id"
    )


def member_timeline_q(spark: SparkSession, d: str) -> DataFrame:
    """Per member: rows of DEMO ⋈ ELIG ⟕ COB, rows with a COB match, first and last span."""
    return ch.timeline_counts(fx.demo(spark, d), fx.elig(spark, d), fx.cob(spark, d))


def member_timeline_rows_q(spark: SparkSession, d: str) -> DataFrame:
    """The rows of DEMO ⋈ ELIG ⟕ COB by member and policy: how many, the first and the last span, the eligible rows, and the distinct spans."""
    elig = fx.elig(spark, d)
    rows = ch.member_timeline(ch.with_distinct_spans(fx.demo(spark, d), elig, "_spans"), elig, fx.cob(spark, d))
    return rows.groupBy("CM_DEMO_MEME_CK", "CM_COB_POLICY_ID", "CM_COB_EFF_DT").agg(
        F.count(F.lit(1)).alias("timeline_rows"),
        F.min("CM_ELIG_EFF_DT").alias("first_eff"),
        F.max("CM_ELIG_TERM_DT").alias("last_term"),
        F.count(F.when(F.col("CM_MEPE_ELIG_IND") == "Y", True)).alias("eligible_rows"),
        F.max("_spans").alias("distinct_spans"),
    )


def composite_keys_q(spark: SparkSession, d: str) -> DataFrame:
    return ch.with_composite_keys(_timeline(spark, d)).select(
        "CM_ELIG_MEME_CK",
        "CM_ELIG_EFF_DT",
        "CM_ELIG_TERM_DT",
        "GRGR_ID_CSPI_ID",
        "GRGR_ID_CSCS_ID_SGSG_ID",
        "GRGR_ID_CSPI_ID_CSCS_ID",
        "GRGR_ID_CSPI_ID_SGSG_ID",
        "GRGR_ID_SGSG_ID",
        "GRGR_ID_CSCS_ID",
        "SBSB_ID",
        "MEME_MEDCD_NO",
    )


def reason_code_q(spark: SparkSession, d: str) -> DataFrame:
    return opt.reason_code(_maintenance(spark, d), fx.member_spans(spark, d))


def state_scaffold_q(spark: SparkSession, d: str) -> DataFrame:
    parts = extract_parts(fx.demo(spark, d), fx.elig(spark, d), fx.prpr(spark, d), fx.prrg(spark, d), fx.AS_OF)
    return opt.state_scaffold(parts, fx.static_states(spark, d), present_in=[parts[0], elig_body(_detail(spark, d))])


QUERIES: dict[str, Query] = {
    "active_members": active_members_q,
    "demo_records": lambda s, d: demo_records(_members(s, d)),
    "span_detail": span_detail_q,
    "elig_body": lambda s, d: elig_body(_detail(s, d)),
    "latest_registration": lambda s, d: latest_registration(fx.prrg(s, d)),
    "with_registration": lambda s, d: _with_reg(s, d).select(
        "CM_ELIG_SBSB_ID", "CM_ELIG_EFF_DT", "CM_PRPR_ID", "PRCR_ID", "elig_pcp_mdcd_id"
    ),
    "elig_records": lambda s, d: elig_records(with_registration(with_body(_detail(s, d)), fx.prpr(s, d), fx.prrg(s, d), printed=True)),
    "extract_records": _extract,
    "extract_by_state": extract_by_state_q,
    "delimited_roundtrip": delimited_roundtrip_q,
    "table_slice_roundtrip": table_slice_roundtrip_q,
    "extract_file_lines": extract_file_lines_q,
    "extract_one_file_lines": extract_one_file_lines_q,
    "sql_views": sql_views_q,
    "typed_span_detail": typed_span_detail_q,
    "malformed_lines": malformed_lines_q,
    "prepared_joins": prepared_joins_q,
    "state_snapshot_roundtrip": state_snapshot_roundtrip_q,
    "catalog_registration": catalog_registration_q,
    "member_timeline": member_timeline_q,
    "member_timeline_rows": member_timeline_rows_q,
    "composite_keys": composite_keys_q,
    "state_deleted_keys": lambda s, d: _change(s, d).deleted_keys,
    "state_kept": lambda s, d: _change(s, d).kept,
    "state_new_spans": lambda s, d: _change(s, d).new_spans,
    "state_rejects": lambda s, d: _change(s, d).rejects.select(*ch.STATE_COLS, "reason", "EFF_RAW", "TERM_RAW"),
    "state_after_change": lambda s, d: _change(s, d).state_after,
    "cob_semi": lambda s, d: opt.cob_of_members(fx.cob(s, d), fx.demo(s, d)),
    "cob_top5": _cob_top,
    "cob_records": lambda s, d: cob_records(_cob_top(s, d)),
    "extract_with_cob": lambda s, d: build_extract(
        fx.demo(s, d), fx.elig(s, d), fx.prpr(s, d), fx.prrg(s, d), fx.AS_OF, cob=fx.cob(s, d)
    ),
    "max_span": lambda s, d: opt.max_span(fx.elig(s, d)),
    "maintenance_code": _maintenance,
    "reason_code": reason_code_q,
    "state_scaffold": state_scaffold_q,
}

__all__ = ["QUERIES", "Query"]
