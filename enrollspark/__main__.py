"""Command-line job: ``spark-submit --py-files enrollspark.zip -m enrollspark ...`` or ``python -m enrollspark ...``.

Runs one extract (and, in ``CHANGE`` mode, replaces the changed members' spans in
the state under ``--state-root``). Provider tables are catalog table names or parquet paths.
Prints one JSON line with the result.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import sys

from pyspark.sql import DataFrame, SparkSession

from enrollspark.plans.extract import CHANGE_MODE, ExtractConfig, run_extract
from enrollspark.session import EXTRACT_CONF


def _table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(name) if "/" in name else spark.read.table(name)


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="enrollspark", description=__doc__.splitlines()[0])
    p.add_argument("--vendor", required=True)
    p.add_argument("--state", required=True, help="state id of the run (input and output folder name)")
    p.add_argument("--mode", required=True, help="extraction mode; CHANGE also updates the span state")
    p.add_argument("--staging-dir", default="", help="root of <vendor>/<mode>/<state>/{DEMOFILE,ELIGFILE,COBFILE}")
    p.add_argument("--layouts-dir", default="", help="root of {DEMO,ELIG,COB}LAYOUT header files")
    p.add_argument("--demo-table", help="DEMO input as a vendor/mode/state-partitioned parquet table (instead of files)")
    p.add_argument("--elig-table", help="ELIG input table (with --demo-table)")
    p.add_argument("--cob-table", help="COB input table (with --demo-table and --include-cob)")
    p.add_argument("--output-dir", required=True)
    p.add_argument("--providers", required=True, help="provider table (PRPR_ID, PRCR_ID): catalog name or parquet path")
    p.add_argument("--registrations", required=True, help="registration table (PRCR_ID, PRRG_MCTR_TYPE, PRRG_SEQ_NO, PRRG_ID)")
    p.add_argument("--state-root", help="root of the span state (CHANGE mode)")
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today(), help="run date, yyyy-mm-dd")
    p.add_argument("--single-file", action="store_true", help="write one file (one task) instead of ordered part files")
    p.add_argument("--include-cob", action="store_true", help="add type-3 COB records")
    p.add_argument("--strict-width", action="store_true", help="pad every record to 1000 characters")
    p.add_argument("--shuffle-partitions", type=int,
                   help="initial shuffle partitions (about shuffle bytes / 200 MB); AQE coalesces small ones")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parse_args(sys.argv[1:] if argv is None else argv)
    tables = {k: v for k, v in (("DEMO", a.demo_table), ("ELIG", a.elig_table), ("COB", a.cob_table)) if v}
    if not tables and not (a.staging_dir and a.layouts_dir):
        raise SystemExit("give --staging-dir and --layouts-dir, or --demo-table and --elig-table")
    need = {"DEMO", "ELIG", *(["COB"] if a.include_cob else [])}
    if tables and need - set(tables):
        raise SystemExit("table inputs lack " + ", ".join(f"--{k.lower()}-table" for k in sorted(need - set(tables))))
    if a.mode == CHANGE_MODE and not a.state_root:
        raise SystemExit("--mode CHANGE needs --state-root")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    if spark is None:
        b = SparkSession.builder.appName(f"{a.vendor}_{a.state}_{a.mode}_EXTRACT")
        for k, v in EXTRACT_CONF.items():
            b = b.config(k, v)
        spark = b.getOrCreate()
    if a.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(a.shuffle_partitions))
    cfg = ExtractConfig(
        vendor=a.vendor,
        state=a.state,
        mode=a.mode,
        staging_dir=a.staging_dir,
        layouts_dir=a.layouts_dir,
        output_dir=a.output_dir,
        state_root=a.state_root,
        as_of=a.as_of,
        strict_width=a.strict_width,
        single_file=a.single_file,
        include_cob=a.include_cob,
        input_tables=tables or None,
    )
    res = run_extract(spark, cfg, _table(spark, a.providers), _table(spark, a.registrations))
    out = {
        "rows": res.rows,
        "seconds": round(res.seconds, 3),
        "output": res.output_path,
        "state_buckets": res.state_buckets,
        "rejects": res.rejects,
    }
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
