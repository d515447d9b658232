"""The extract as one Spark job: records, global sort, text sink, and the CHANGE state update."""

from __future__ import annotations

import datetime as dt
import logging
import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from enrollspark.functions.layout import ELIG_TAIL_LAYOUT
from enrollspark.functions.text import pad, spaces
from enrollspark.operators.change import eligible_spans, normalised_spans, replace_spans, replaced_members
from enrollspark.operators.optional import cob_top, cob_with_members
from enrollspark.operators.providers import ID_WIDTH, IDS, latest_registration, medicaid_id, with_provider, with_registration
from enrollspark.operators.records import (
    BODY,
    SORT_KEYS,
    cob_records,
    demo_records,
    elig_records,
    merge_records,
    with_body,
)
from enrollspark.operators.spans import active_members, current_spans, repeat_rows, span_detail
from enrollspark.plans.views import extract_views
from enrollspark.session import remove_path, scratch_path
from enrollspark.sources.delimited import REQUIRED_COLUMNS, read_input, require_columns
from enrollspark.sources.joined import join_files
from enrollspark.sources.state import update_state
from enrollspark.sources.tables import read_slice

log = logging.getLogger(__name__)

CHANGE_MODE = "CHANGE"
SPAN_RECORD = 2  # REC_NUM of a span's record, the one with a registered id
HELD_IDS = 500_000  # registered ids that every task may hold
LINES = 500_000  # records of a part file
RANGES = 256  # that are sorted side by side
FILES = 1000  # of a range: their names, which end with three digits, are their order
TAIL_WIDTH = ELIG_TAIL_LAYOUT.width


def extract_parts(
    demo: DataFrame,
    elig: DataFrame,
    prpr: DataFrame,
    prrg: DataFrame,
    as_of: dt.date,
    cob: DataFrame | None = None,
    strict_width: bool = False,
) -> list[DataFrame]:
    """The extract's record sets: type 1 per active member row, type 2 per span detail row with
    the provider's latest Medicaid id, and type 3 when ``cob`` is given."""
    members = active_members(demo, elig, as_of)
    spans = with_registration(with_body(span_detail(elig, demo, as_of)), prpr, prrg, printed=True)
    parts = [demo_records(members, strict_width), elig_records(spans)]
    if cob is not None:
        parts.append(cob_records(cob_with_members(cob_top(cob), demo)))
    return parts


def build_extract(
    demo: DataFrame,
    elig: DataFrame,
    prpr: DataFrame,
    prrg: DataFrame,
    as_of: dt.date,
    cob: DataFrame | None = None,
    strict_width: bool = False,
) -> DataFrame:
    """All records of the extract (unsorted), the union of ``extract_parts``."""
    return merge_records(*extract_parts(demo, elig, prpr, prrg, as_of, cob, strict_width))


def sort_records(records: DataFrame, parts: int | None = None) -> DataFrame:
    """Records in file order (subscriber, record number, effective date, record text).

    Range partitions by the sort keys, each sorted, so part files in name order are
    the file; their number is ``parts``, or follows the data's size (AQE). Give staged
    records: the sampling of the ranges reads them once more.
    """
    keys = [F.col(k).asc_nulls_first() for k in SORT_KEYS]
    ranged = records.repartitionByRange(parts, *keys) if parts else records.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def one_after_another(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a Parquet folder in one partition: its files in name order, each in row order, nothing sorted.

    Spark packs the files of one scan by size, so every file is a scan of its own; their union
    keeps the order, and so does a coalesce to one partition.
    """
    whole = spark.read.parquet(path)
    files = sorted(whole.inputFiles(), key=lambda f: f.rsplit("/", 1)[-1])  # as many as the sorted parts
    if not files:
        return whole.coalesce(1)
    return reduce(DataFrame.union, [spark.read.schema(whole.schema).parquet(f) for f in files]).coalesce(1)


def write_records(records: DataFrame, path: str, single_file: bool = False, parts: int | None = None) -> int:
    """Write the sorted ``rec_type`` column as text (overwrite) and return the record count.

    The records are staged once before they are sorted into ranges, so that neither
    the joins nor the encoding run twice; the count is observed during the write. With
    ``single_file`` the sorted ranges are staged, and one task writes them
    one after another: it sorts nothing and holds no more than a batch.
    """
    spark = records.sparkSession
    staged, ordered = scratch_path(spark, "records"), scratch_path(spark, "ordered")
    obs = Observation("extract")
    out = sort_records(stage(records, staged), parts).observe(obs, F.count(F.lit(1)).alias("rows")).select("rec_type")
    if single_file:
        out.write.parquet(ordered)
        one_after_another(spark, ordered).write.mode("overwrite").text(path)
        remove_path(spark, ordered)
    else:
        out.write.mode("overwrite").text(path)
    remove_path(spark, staged)
    return int(obs.get["rows"])


def record_bodies(
    demo: DataFrame, elig: DataFrame, as_of: dt.date, cob: DataFrame | None = None, strict_width: bool = False
) -> DataFrame:
    """The extract before its spans meet the registrations: a row per record, but one per span for the
    type 2, with the span's provider and no registered id. Its rows grow with the inputs, those of the
    extract with spans times ties of a registration."""
    spans = with_body(span_detail(elig, demo, as_of))
    parts = [demo_records(active_members(demo, elig, as_of), strict_width)]
    if cob is not None:
        parts.append(cob_records(cob_with_members(cob_top(cob), demo)))
    whole = merge_records(*parts).withColumn("CM_PRPR_ID", F.lit(None).cast("string")).withColumnRenamed("rec_type", BODY)
    span = [F.col(BODY), F.col("CM_ELIG_SBSB_ID").alias("SBSB_ID"), F.lit(SPAN_RECORD).alias("REC_NUM"), F.col("CM_ELIG_EFF_DT").alias("EFF_DT"), "CM_PRPR_ID"]
    return whole.select(BODY, "SBSB_ID", "REC_NUM", "EFF_DT", "CM_PRPR_ID").unionByName(spans.select(*span))


def registered_ids(groups: DataFrame, prrg: DataFrame, ids: int = IDS) -> DataFrame:
    """The padded registered ids of each of ``groups`` (column ``_of``, distinct: provider groups and how often each is met)
    in order, by ``_chunk`` of at most ``ids``: ``_ids``."""
    met = groups.select("_of", F.explode("_of").alias("_g")).select("_of", F.col("_g.PRCR_ID").alias("_prcr"), F.col("_g.n").alias("_n"))
    j = met.join(latest_registration(prrg), F.col("_prcr") == F.col("PRCR_ID"), "left")
    each = repeat_rows(j.select("_of", "_n", pad(medicaid_id(F.col("PRRG_MCTR_TYPE"), F.col("PRRG_ID")), ID_WIDTH).alias("_id")), "_n")
    at = F.row_number().over(Window.partitionBy("_of").orderBy("_id")) - 1
    chunk = F.floor(at / ids).cast("int")
    return each.withColumn("_chunk", chunk).groupBy("_of", "_chunk").agg(F.sort_array(F.collect_list("_id")).alias("_ids"))


def write_extract(
    bodies: DataFrame,
    prpr: DataFrame,
    prrg: DataFrame,
    path: str,
    single_file: bool = False,
    compression: str = "none",
    lines: int = LINES,
    held: int = HELD_IDS,
) -> int:
    """Write the extract of ``bodies`` (``record_bodies``), sorted as ``write_records`` does, and return the record count.

    Bodies are sorted, not records: equal ones are one with a count, and one that meets
    several registrations is followed by their ids in order, which is the order of the records. So what
    is staged and shuffled grows with the spans; the records are made by the task that writes them.
    While the distinct ids are at most ``held`` they go to every task; more are shuffled to the bodies before
    the sort, in chunks.

    Spark brings some 300 whole sort keys of each range to the driver, so there are at most RANGES of them, however many
    the records; a range's files hold ``lines`` records each, or more where it might have over FILES files. With
    ``single_file`` the files are joined (``join_files``), so that one file is written by as many tasks.
    """
    spark = bodies.sparkSession
    staged, ids_at, ordered = (scratch_path(spark, n) for n in ("bodies", "ids", "ordered"))
    keys = ["SBSB_ID", "REC_NUM", "EFF_DT", BODY]
    span = F.col("REC_NUM") == SPAN_RECORD
    # each body once; a body is that of several groups only where its provider is listed with several
    b = with_provider(bodies, prpr).groupBy(*keys, "PRCR_ID").agg(F.count(F.lit(1)).alias("n"))
    b = b.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("PRCR_ID", "n"))).alias("_of"))
    one = F.size("_of") == 1
    b = b.withColumn("_times", F.when(one, F.col("_of")[0]["n"]).otherwise(F.when(span, F.lit(1).cast("long"))))
    b = b.withColumn("_of", F.when(span, F.when(one, F.transform("_of", lambda g: F.struct(g["PRCR_ID"].alias("PRCR_ID"), F.lit(1).cast("long").alias("n")))).otherwise(F.col("_of"))))
    b = stage(b, staged)
    ids = stage(registered_ids(b.filter("_of IS NOT NULL").select("_of").distinct(), prrg), ids_at)
    many = ids.groupBy("_of").agg(F.sum(F.size("_ids")).alias("_many"))
    rows = int(b.join(many, "_of", "left").agg(F.sum(F.col("_times") * F.coalesce("_many", F.lit(1)))).first()[0] or 0)
    lines = max(lines, -(-rows // FILES))
    parts = max(1, min(-(-rows // lines), RANGES))
    order = [F.col(k).asc_nulls_first() for k in keys]
    if (ids.agg(F.sum(F.size("_ids"))).first()[0] or 0) <= held:
        out = b.repartitionByRange(parts, *order).join(F.broadcast(ids), "_of", "left")
    else:
        out = b.join(ids, "_of", "left").repartitionByRange(parts, *order, F.col("_chunk").asc_nulls_first())
    out = out.sortWithinPartitions(*order, "_chunk").select(BODY, "_ids", "_times")
    tails = F.when(F.col("_ids").isNull(), F.array(F.lit(""))).otherwise(F.col("_ids"))
    rest = F.when(F.col("_ids").isNull(), F.lit("")).otherwise(spaces(TAIL_WIDTH - ID_WIDTH))
    out = repeat_rows(out.select(BODY, rest.alias("_rest"), "_times", F.explode(tails).alias("_id")), "_times")
    obs = Observation("extract")
    out = out.select(F.concat(BODY, "_id", "_rest").alias("rec_type")).observe(obs, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").option("compression", compression).option("maxRecordsPerFile", lines).text(ordered if single_file else path)
    if single_file:
        join_files(spark, ordered, path)
    for p in (staged, ids_at, ordered):
        remove_path(spark, p)
    return int(obs.get["rows"])


@dataclass(frozen=True)
class ExtractConfig:
    """Arguments of one run: where the inputs, layouts and outputs are, and what to do."""

    vendor: str
    state: str
    mode: str
    staging_dir: str
    layouts_dir: str
    output_dir: str
    state_root: str | None = None
    as_of: dt.date = field(default_factory=dt.date.today)
    strict_width: bool = False
    single_file: bool = False
    include_cob: bool = False
    stage_spans: bool = True
    # count the lines of delimited inputs that don't fit their layout (the inputs are staged whole)
    check_lines: bool = False
    # SQL over the run's views (see plans/views.py): name -> query, written as Parquet to report_path(name)
    reports: dict[str, str] | None = None
    # inputs as partitioned tables instead of delimited files: kind (DEMO, ELIG, COB) -> table root
    input_tables: dict[str, str] | None = None

    def output_path(self) -> str:
        return "/".join([self.output_dir.rstrip("/"), self.vendor, self.mode, self.state])

    def report_path(self, name: str) -> str:
        return "/".join([self.output_dir.rstrip("/"), self.vendor, self.mode, "reports", self.state, name])


@dataclass(frozen=True)
class ExtractResult:
    rows: int
    seconds: float
    output_path: str
    state_buckets: int | None = None
    rejects: int | None = None
    lines: dict[str, dict[str, int]] | None = None


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet to ``path`` and read it back.

    Cuts the lineage (a lost executor recomputes from this table, not from the
    raw files) and lets several branches of one plan read one columnar copy.
    The ``rebalance`` hint lets AQE cut the (filtered) rows into partitions of
    the advisory size, so a selective filter over many input splits does not
    leave one small file per split.
    """
    df.hint("rebalance").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_extract(spark: SparkSession, cfg: ExtractConfig, prpr: DataFrame, prrg: DataFrame) -> ExtractResult:
    """Read the run's files, write the extract, and in ``CHANGE`` mode replace the changed members' spans in the state.

    With ``stage_spans`` the spans containing the run date are parsed from the
    delimited file once and staged as parquet; both span joins read that copy.
    Staged tables have a folder of their own for each run, removed after success. With
    ``check_lines`` the result tells, by input kind, how many lines were read, were short and
    had surplus fields. ``reports`` are run over the run's views.
    """
    if cfg.mode == CHANGE_MODE and not cfg.state_root:
        raise ValueError("a CHANGE run updates the span state: give state_root")
    t0 = time.monotonic()

    def read(kind: str) -> DataFrame:
        if cfg.input_tables:
            df = read_slice(spark, cfg.input_tables[kind], cfg.vendor, cfg.mode, cfg.state)
            require_columns(df.schema, REQUIRED_COLUMNS[kind], f"{kind} table")
            return df
        if not cfg.check_lines:
            return read_input(spark, cfg.layouts_dir, cfg.staging_dir, cfg.vendor, cfg.mode, cfg.state, kind)
        obs, path = Observation(kind), scratch_path(spark, kind.lower())
        df = stage(read_input(spark, cfg.layouts_dir, cfg.staging_dir, cfg.vendor, cfg.mode, cfg.state, kind, obs), path)
        inputs.append(path)
        lines[kind] = dict(obs.get)
        if lines[kind]["short"] or lines[kind]["surplus"]:
            log.warning("%s: %s", kind, lines[kind])
        return df

    inputs: list[str] = []
    lines: dict[str, dict[str, int]] = {}
    demo, elig = read("DEMO"), read("ELIG")
    cob = read("COB") if cfg.include_cob else None
    staged = scratch_path(spark, "spans")
    spans = stage(current_spans(elig, cfg.as_of), staged) if cfg.stage_spans else elig
    bodies = record_bodies(demo, spans, cfg.as_of, cob=cob, strict_width=cfg.strict_width)
    rows = write_extract(bodies, prpr, prrg, cfg.output_path(), single_file=cfg.single_file)
    if cfg.stage_spans:
        remove_path(spark, staged)
    log.info("extract %s/%s/%s: %d records", cfg.vendor, cfg.mode, cfg.state, rows)
    if cfg.reports:
        with extract_views(spark, demo, elig, prpr, prrg, cfg.as_of, cob, cfg.strict_width) as sql:
            for name, query in cfg.reports.items():
                sql(query).write.mode("overwrite").parquet(cfg.report_path(name))
    buckets = rejects = None
    if cfg.mode == CHANGE_MODE:
        buckets, rejects = publish_change(spark, cfg.state_root, demo, elig)
    for path in inputs:
        remove_path(spark, path)
    return ExtractResult(rows, time.monotonic() - t0, cfg.output_path(), buckets, rejects, lines or None)


def publish_change(spark: SparkSession, state_root: str, demo: DataFrame, elig: DataFrame) -> tuple[int, int]:
    """Replace the changed members' spans in the state table; return (buckets rewritten, reject count).

    The candidate spans are staged once: rejects, members and new spans read that
    table. The rejected spans are written to a folder of their own under
    ``<state_root>/rejects`` before the state changes; only the buckets of
    the changed members are rewritten.
    """
    path = scratch_path(spark, "candidates")
    candidates = stage(normalised_spans(eligible_spans(demo, elig)), path)
    obs = Observation("rejects")
    lost = candidates.filter(F.col("reason").isNotNull()).observe(obs, F.count(F.lit(1)).alias("rows"))
    lost.write.parquet(f"{state_root.rstrip('/')}/rejects/{path.rstrip('/').rsplit('/', 1)[-1]}")
    rejects = int(obs.get["rows"])
    if rejects:
        log.warning("change run: %d spans rejected", rejects)
    buckets = update_state(spark, state_root, replaced_members(candidates), lambda rows: replace_spans(rows, candidates).state_after)
    remove_path(spark, path)
    return buckets, rejects
