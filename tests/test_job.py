"""The whole run: delimited inputs through layouts, extract file, CHANGE state publication."""

import glob
import os

import pytest

from conftest import SF_SMALL
from enrollspark.plans.extract import ExtractConfig, run_extract
from enrollspark.sources import fixtures as fx
from enrollspark.sources.delimited import input_path, layout_path, write_delimited
from enrollspark.sources.state import read_state, write_state


def test_change_run_writes_file_and_next_state(spark, tmp_out):
    d = SF_SMALL
    staging, layouts, out, state_root = (f"{tmp_out}/{x}" for x in ("staging", "layouts", "out", "state"))
    vendor, mode, state = "VENDOR", "CHANGE", "ALL"
    inputs = {"DEMO": fx.change_demo(spark, d), "ELIG": fx.change_elig(spark, d)}
    for kind, df in inputs.items():
        write_delimited(df, input_path(staging, vendor, mode, state, kind), layout_path(layouts, kind))
    write_state(fx.span_state(spark, d), state_root)

    cfg = ExtractConfig(
        vendor=vendor, state=state, mode=mode, staging_dir=staging, layouts_dir=layouts, output_dir=out,
        state_root=state_root, as_of=fx.AS_OF, single_file=True,
    )
    res = run_extract(spark, cfg, fx.prpr(spark, d), fx.prrg(spark, d))
    files = glob.glob(f"{res.output_path.removeprefix('file:')}/part-*")
    assert len(files) == 1
    with open(files[0], encoding="utf-8") as f:
        assert sum(1 for _ in f) == res.rows > 0
    assert 0 < res.state_buckets <= 64
    assert res.rejects == 5
    assert spark.read.parquet(f"{state_root}/rejects/*").count() == 5
    assert read_state(spark, state_root).count() == 682


def test_full_run_leaves_state_alone(spark, tmp_out):
    d = SF_SMALL
    staging, layouts, out = (f"{tmp_out}/{x}" for x in ("staging", "layouts", "out"))
    for kind, df in (("DEMO", fx.demo(spark, d)), ("ELIG", fx.elig(spark, d))):
        write_delimited(df, input_path(staging, "V", "FULL", "DC", kind), layout_path(layouts, kind))
    cfg = ExtractConfig(vendor="V", state="DC", mode="FULL", staging_dir=staging, layouts_dir=layouts,
                        output_dir=out, state_root=f"{tmp_out}/state", as_of=fx.AS_OF)
    res = run_extract(spark, cfg, fx.prpr(spark, d), fx.prrg(spark, d))
    assert res.rows == 332
    assert res.state_buckets is None and res.lines is None
    assert read_state(spark, f"{tmp_out}/state").count() == 0


def test_command_line_job(spark, tmp_out):
    from enrollspark.__main__ import main

    d = SF_SMALL
    staging, layouts, out = (f"{tmp_out}/{x}" for x in ("staging", "layouts", "out"))
    for kind, df in (("DEMO", fx.demo(spark, d)), ("ELIG", fx.elig(spark, d)), ("COB", fx.cob(spark, d))):
        write_delimited(df, input_path(staging, "V", "FULL", "ALL", kind), layout_path(layouts, kind))
    fx.prpr(spark, d).write.parquet(f"{tmp_out}/prpr")
    fx.prrg(spark, d).write.parquet(f"{tmp_out}/prrg")
    res = main(
        ["--vendor", "V", "--state", "ALL", "--mode", "FULL", "--staging-dir", staging, "--layouts-dir", layouts,
         "--output-dir", out, "--providers", f"{tmp_out}/prpr", "--registrations", f"{tmp_out}/prrg",
         "--as-of", fx.AS_OF.isoformat(), "--include-cob"],
        spark=spark,
    )
    assert res["rows"] == 332 + 375
    assert res["state_buckets"] is None


def test_run_from_partitioned_tables(spark, tmp_out):
    from enrollspark.sources.tables import write_slice

    d = SF_SMALL
    tables = {k: f"{tmp_out}/{k.lower()}" for k in ("DEMO", "ELIG")}
    write_slice(fx.demo(spark, d), tables["DEMO"], "V", "FULL", "DC")
    write_slice(fx.elig(spark, d), tables["ELIG"], "V", "FULL", "DC")
    write_slice(fx.change_demo(spark, d), tables["DEMO"], "V", "CHANGE", "DC")  # another slice, not read
    cfg = ExtractConfig(vendor="V", state="DC", mode="FULL", staging_dir="", layouts_dir="", output_dir=f"{tmp_out}/out",
                        as_of=fx.AS_OF, input_tables=tables)
    res = run_extract(spark, cfg, fx.prpr(spark, d), fx.prrg(spark, d))
    assert res.rows == 332


def test_repeated_change_run_publishes_identical_state(spark, tmp_out):
    d = SF_SMALL
    staging, layouts, state_root = (f"{tmp_out}/{x}" for x in ("staging", "layouts", "state"))
    for kind, df in (("DEMO", fx.change_demo(spark, d)), ("ELIG", fx.change_elig(spark, d))):
        write_delimited(df, input_path(staging, "V", "CHANGE", "DC", kind), layout_path(layouts, kind))
    write_state(fx.span_state(spark, d), state_root)
    cfg = ExtractConfig(vendor="V", state="DC", mode="CHANGE", staging_dir=staging, layouts_dir=layouts,
                        output_dir=f"{tmp_out}/out", state_root=state_root, as_of=fx.AS_OF)
    first = run_extract(spark, cfg, fx.prpr(spark, d), fx.prrg(spark, d))
    once = sorted(tuple(r) for r in read_state(spark, state_root).collect())
    second = run_extract(spark, cfg, fx.prpr(spark, d), fx.prrg(spark, d))
    twice = sorted(tuple(r) for r in read_state(spark, state_root).collect())
    assert first.state_buckets == second.state_buckets
    assert once == twice and len(once) == 682


def test_lines_are_counted_and_reports_written(spark, tmp_out):
    d = SF_SMALL
    staging, layouts = f"{tmp_out}/staging", f"{tmp_out}/layouts"
    for kind, df in (("DEMO", fx.demo(spark, d)), ("ELIG", fx.elig(spark, d))):
        write_delimited(df, input_path(staging, "V", "FULL", "DC", kind), layout_path(layouts, kind))
    with open(f"{input_path(staging, 'V', 'FULL', 'DC', 'DEMO')}/more.txt".removeprefix("file:"), "w") as f:
        f.write("DEMO|nobody\n")
    cfg = ExtractConfig(vendor="V", state="DC", mode="FULL", staging_dir=staging, layouts_dir=layouts, output_dir=f"{tmp_out}/out",
                        as_of=fx.AS_OF, check_lines=True, reports={"kinds": "SELECT REC_NUM, count(*) AS n FROM records GROUP BY REC_NUM"})
    res = run_extract(spark, cfg, fx.prpr(spark, d), fx.prrg(spark, d))
    assert res.rows == 332
    demo, elig = fx.demo(spark, d).count(), fx.elig(spark, d).count()
    assert res.lines == {"DEMO": {"lines": demo + 1, "short": 1, "surplus": 0}, "ELIG": {"lines": elig, "short": 0, "surplus": 0}}
    got = {r["REC_NUM"]: r["n"] for r in spark.read.parquet(cfg.report_path("kinds")).collect()}
    assert got == {1: 160, 2: 172}


def test_a_change_run_without_a_state_fails_before_any_work(spark, tmp_out):
    cfg = ExtractConfig(vendor="V", state="DC", mode="CHANGE", staging_dir=f"{tmp_out}/none", layouts_dir=f"{tmp_out}/none", output_dir=f"{tmp_out}/out")
    with pytest.raises(ValueError, match="state_root"):
        run_extract(spark, cfg, fx.prpr(spark, SF_SMALL), fx.prrg(spark, SF_SMALL))
    assert not os.path.exists(f"{tmp_out}/out".removeprefix("file:"))


def test_command_line_checks_its_arguments(spark):
    from enrollspark.__main__ import main

    base = ["--vendor", "V", "--state", "DC", "--output-dir", "o", "--providers", "p", "--registrations", "r"]
    for more, what in (
        (["--mode", "FULL"], "--staging-dir"),
        (["--mode", "FULL", "--demo-table", "d"], "--elig-table"),
        (["--mode", "FULL", "--demo-table", "d", "--elig-table", "e", "--include-cob"], "--cob-table"),
        (["--mode", "CHANGE", "--staging-dir", "s", "--layouts-dir", "l"], "--state-root"),
    ):
        with pytest.raises(SystemExit, match=what):
            main(base + more, spark=spark)


def test_table_inputs_must_have_the_columns(spark, tmp_out):
    from enrollspark.sources.tables import write_slice

    d = SF_SMALL
    tables = {k: f"{tmp_out}/{k.lower()}" for k in ("DEMO", "ELIG")}
    write_slice(fx.demo(spark, d), tables["DEMO"], "V", "FULL", "DC")
    write_slice(fx.elig(spark, d).drop("CM_PRPR_NAME"), tables["ELIG"], "V", "FULL", "DC")
    cfg = ExtractConfig(vendor="V", state="DC", mode="FULL", staging_dir="", layouts_dir="", output_dir=f"{tmp_out}/out", input_tables=tables)
    with pytest.raises(ValueError, match="CM_PRPR_NAME"):
        run_extract(spark, cfg, fx.prpr(spark, d), fx.prrg(spark, d))


def test_staged_tables_are_removed_after_success(spark, tmp_out):
    from enrollspark.plans.extract import build_extract, write_records
    from enrollspark.session import shared_dir

    d = SF_SMALL
    root = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    write_records(build_extract(fx.demo(spark, d), fx.elig(spark, d), fx.prpr(spark, d), fx.prrg(spark, d), fx.AS_OF), f"{tmp_out}/x")
    assert not [n for n in set(os.listdir(root)) - before if n.startswith("records-")]
