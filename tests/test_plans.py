"""Plan properties that matter at scale: pruned scans, map-side limits, no Python in the hot path."""

from conftest import SF_SMALL
from enrollspark.plans.queries import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_anywhere(spark):
    for name, q in QUERIES.items():
        p = _plan(q(spark, SF_SMALL))
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name


def test_top_k_and_latest_use_map_side_group_limit(spark):
    for name in ("latest_registration", "cob_top5", "state_new_spans"):
        p = _plan(QUERIES[name](spark, SF_SMALL))
        assert "WindowGroupLimit" in p and "Partial" in p, name


def test_cob_limit_lies_below_the_exchange_with_shuffle_joins(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        for name in ("cob_top5", "cob_records", "extract_with_cob"):
            p = _plan(QUERIES[name](spark, SF_SMALL))
            lines = p.splitlines()
            partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit [CM_COB_SBSB_ID" in line and "Partial" in line)
            assert any("Exchange hashpartitioning(CM_COB_SBSB_ID" in line for line in lines[:partial]), name
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_replaced_members_need_no_window_or_distinct(spark):
    p = _plan(QUERIES["state_kept"](spark, SF_SMALL).select("row_key"))
    assert p.count("Window [") <= 1 and "LeftAnti" in p  # the one window makes the fixture's prior state


def test_scans_read_only_needed_columns(spark):
    p = _plan(QUERIES["latest_registration"](spark, SF_SMALL))
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in p or "struct<p_partkey:bigint,p_size:int>" in p
    p = _plan(QUERIES["max_span"](spark, SF_SMALL))
    assert "o_totalprice" not in p


def test_delimited_scan_gets_indicator_filter_and_pruned_columns(spark, tmp_out):
    from enrollspark.operators.spans import active_spans
    from enrollspark.sources import fixtures as fx
    from enrollspark.sources.delimited import layout_schema, read_delimited, write_delimited

    write_delimited(fx.elig(spark, SF_SMALL), f"{tmp_out}/d", f"{tmp_out}/l")
    elig = read_delimited(spark, f"{tmp_out}/d", layout_schema(spark, f"{tmp_out}/l"))
    p = _plan(active_spans(elig, fx.AS_OF).select("CM_ELIG_MEME_CK"))
    assert "PushedFilters: [IsNotNull(CM_MEPE_ELIG_IND), EqualTo(CM_MEPE_ELIG_IND,Y)]" in p
    assert ("ReadSchema: struct<CM_ELIG_MEME_CK:string,CM_ELIG_EFF_DT:string,CM_ELIG_TERM_DT:string,"
            "CM_MEPE_ELIG_IND:string>") in p


def _no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    return old


def _restore(spark, old):
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_prepared_tables_join_without_an_exchange(spark):
    from enrollspark.operators.change import member_timeline
    from enrollspark.operators.spans import active_members
    from enrollspark.plans.queries import prepared_tables
    from enrollspark.sources import fixtures as fx

    demo, elig, state = prepared_tables(spark, SF_SMALL, 4)
    t = spark.read.table
    old = _no_broadcast(spark)
    try:
        kept = t(state["member"]).join(t(elig["member"]).select("CM_ELIG_MEME_CK"), t(state["member"])["MEME_CK"] == t(elig["member"])["CM_ELIG_MEME_CK"], "left_anti")
        joins = {
            "JN-1": active_members(t(demo["span"]), t(elig["span"]), fx.AS_OF),
            "JN-6": member_timeline(t(demo["member"]), t(elig["member"])),
            "JN-8": kept,
        }
        for name, df in joins.items():
            df.collect()
            p = _plan(df)
            assert "SortMergeJoin" in p and "Exchange" not in p and "Bucketed: true" in p, name
        plain = active_members(fx.demo(spark, SF_SMALL), fx.elig(spark, SF_SMALL), fx.AS_OF)
        assert "Exchange" in _plan(plain)
        assert sorted(map(str, joins["JN-1"].collect())) == sorted(map(str, plain.collect()))
    finally:
        _restore(spark, old)


def test_run_date_reaches_the_scan_of_typed_spans(spark, tmp_out):
    from enrollspark.operators.spans import active_spans, current_spans
    from enrollspark.sources import fixtures as fx
    from enrollspark.sources.tables import write_spans

    elig = fx.elig(spark, SF_SMALL)
    spans = write_spans(elig, f"{tmp_out}/typed")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # of the scan's filters in the plan's text
    try:
        p = _plan(active_spans(spans, fx.AS_OF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    day = fx.AS_OF.isoformat()
    assert f"LessThanOrEqual(EFF_DATE,{day})" in p and f"GreaterThanOrEqual(TERM_DATE,{day})" in p
    for f in (current_spans, active_spans):
        assert f(spans, fx.AS_OF).columns == elig.columns
        assert sorted(map(str, f(spans, fx.AS_OF).collect())) == sorted(map(str, f(elig, fx.AS_OF).collect()))


def test_one_file_is_written_without_a_sort_in_its_task(spark, tmp_out):
    from enrollspark.plans.extract import one_after_another

    # several row groups and files, whose sizes fall and rise, so that packing by size would change the order
    sizes = [50, 4000, 10, 900, 20000, 1]
    for k, n in enumerate(sizes):
        spark.range(n).selectExpr(f"printf('%02d-%06d', {k}, id) AS rec_type").coalesce(1).sortWithinPartitions("rec_type").write.option(
            "parquet.block.size", "20000"
        ).parquet(f"{tmp_out}/p{k}")
    import glob
    import os
    import shutil

    os.makedirs(f"{tmp_out}/all".removeprefix("file:"))
    for k in range(len(sizes)):
        (f,) = glob.glob(f"{tmp_out}/p{k}/part-*.parquet".removeprefix("file:"))
        shutil.copy(f, f"{tmp_out}/all/part-{k:05d}.parquet".removeprefix("file:"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = one_after_another(spark, f"{tmp_out}/all")
        p = _plan(df)
        assert "Sort" not in p and "Exchange" not in p
        rows = [r[0] for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == sum(sizes) and rows == sorted(rows)
