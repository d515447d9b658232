"""Layout-driven delimited input, and the state table."""

import datetime as dt
import glob
import os

import pytest
from helpers import strings
from pyspark.sql import Observation

from enrollspark.sources.delimited import layout_schema, read_checked, read_delimited, require_columns, write_delimited
from enrollspark.sources.state import STATE_SCHEMA, bucket_of, read_state, update_state, write_state


def _write(path, text):
    path = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_layout_header_names_string_columns_and_short_long_lines(spark, tmp_out):
    _write(f"{tmp_out}/layout/part.csv", "A|B|C\n")
    _write(f"{tmp_out}/data/part.txt", "1|x|y\n2|only\n3|a|b|surplus\n4||\n")
    schema = layout_schema(spark, f"{tmp_out}/layout")
    assert schema.fieldNames() == ["A", "B", "C"]
    assert all(f.dataType.typeName() == "string" for f in schema.fields)
    rows = sorted(tuple(r) for r in read_delimited(spark, f"{tmp_out}/data", schema).collect())
    assert rows == [("1", "x", "y"), ("2", "only", None), ("3", "a", "b"), ("4", None, None)]
    with pytest.raises(ValueError, match="lacks columns: D"):
        require_columns(schema, ["A", "D"])


def test_write_then_read_keeps_values_null_and_empty(spark, tmp_out):
    df = strings(spark, ["K", "V", "W"], [("1", " MD ", None), ("2", "", "x|y"), ("3", "a\"b", " ")])
    write_delimited(df, f"{tmp_out}/d", f"{tmp_out}/l")
    back = read_delimited(spark, f"{tmp_out}/d", layout_schema(spark, f"{tmp_out}/l"))
    norm = lambda rows: sorted(tuple(None if v == "" else v for v in r) for r in rows)
    assert norm(back.collect()) == norm(df.collect())


def test_checked_lines_are_counted_and_rows_stay(spark, tmp_out):
    _write(f"{tmp_out}/layout/part.csv", "A|B|C\n")
    _write(f"{tmp_out}/data/part.txt", '1|x|y\n2|only\n3|a|b|surplus\n4||\n5\n6|"q|r"|s\n7|"q|r"\n8|a"b|c"d|e\n9|"a\\"|b"|c\n')
    schema = layout_schema(spark, f"{tmp_out}/layout")
    obs = Observation("lines")
    rows = sorted(tuple(r) for r in read_checked(spark, f"{tmp_out}/data", schema, obs).collect())
    assert rows == sorted(tuple(r) for r in read_delimited(spark, f"{tmp_out}/data", schema).collect()) and len(rows) == 9
    assert obs.get == {"lines": 9, "short": 3, "surplus": 2}


def test_state_is_written_read_and_replaced(spark, tmp_out):
    root = f"{tmp_out}/state"
    assert read_state(spark, root).count() == 0 and read_state(spark, root).columns == STATE_SCHEMA.fieldNames()
    row = ("1_2020-01-01", "1", dt.date(2020, 1, 1), None, "", "", "", "", "")
    write_state(spark.createDataFrame([row, row, (None, "x", *row[2:])], STATE_SCHEMA), root)
    assert sorted(map(str, read_state(spark, root).collect())) == sorted(map(str, spark.createDataFrame([row, row, (None, "x", *row[2:])], STATE_SCHEMA).collect()))
    write_state(spark.createDataFrame([row], STATE_SCHEMA), root)
    assert [tuple(r) for r in read_state(spark, root).collect()] == [row]


def _row(member, day, cspi=""):
    return (f"{member}_2020-01-{day:02d}", str(member), dt.date(2020, 1, day), None, cspi, "", "", "", "")


def _files(root):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root.removeprefix('file:')}/spans/bucket=*/*.parquet")}


def _put(spark, root, rows):
    new = spark.createDataFrame(rows, STATE_SCHEMA)
    change = lambda old: old.join(new.select("MEME_CK").distinct(), "MEME_CK", "left_anti").select(*new.columns).unionByName(new)
    return update_state(spark, root, new, change)


def test_a_change_rewrites_only_the_buckets_of_its_members(spark, tmp_out):
    root = f"{tmp_out}/state"
    write_state(spark.createDataFrame([_row(m, d) for m in range(200) for d in (1, 2)], STATE_SCHEMA), root)
    before = _files(root)
    assert _put(spark, root, [_row(7, 9, "new")]) == 1
    b = spark.createDataFrame([("7",)], "MEME_CK string").select(bucket_of()).first()[0]
    changed = {f for f in before if f"/bucket={b}/" in f}
    after = _files(root)
    assert changed and all(after.get(f) == t for f, t in before.items() if f not in changed)
    assert not changed & set(after)
    got = read_state(spark, root)
    assert got.count() == 399 and [r["CSPI_ID"] for r in got.filter("MEME_CK = '7'").collect()] == ["new"]


def test_a_change_applied_again_gives_the_same_rows(spark, tmp_out):
    root = f"{tmp_out}/state"
    write_state(spark.createDataFrame([_row(m, 1) for m in range(50)], STATE_SCHEMA), root)
    _put(spark, root, [_row(5, 3), _row(6, 3), _row(900, 4)])
    once = sorted(map(str, read_state(spark, root).collect()))
    _put(spark, root, [_row(5, 3), _row(6, 3), _row(900, 4)])
    assert sorted(map(str, read_state(spark, root).collect())) == once and len(once) == 51


def test_a_bucket_can_be_emptied_and_filled_again(spark, tmp_out):
    root = f"{tmp_out}/state"
    write_state(spark.createDataFrame([_row(m, 1) for m in range(3)], STATE_SCHEMA), root)
    one = spark.createDataFrame([("1",)], "MEME_CK string")
    assert update_state(spark, root, one, lambda old: old.filter("MEME_CK <> '1'")) == 1
    assert sorted(r["MEME_CK"] for r in read_state(spark, root).collect()) == ["0", "2"]
    _put(spark, root, [_row(1, 8)])
    assert sorted(r["row_key"] for r in read_state(spark, root).collect()) == ["0_2020-01-01", "1_2020-01-08", "2_2020-01-01"]
    assert update_state(spark, root, one.limit(0), lambda old: old) == 0


def test_only_touched_partitions_are_read(spark, tmp_out):
    root = f"{tmp_out}/state"
    write_state(spark.createDataFrame([_row(m, 1) for m in range(100)], STATE_SCHEMA), root)
    plans = []

    def change(old):
        plans.append(old._jdf.queryExecution().executedPlan().toString())
        return old

    update_state(spark, root, spark.createDataFrame([("1",)], "MEME_CK string"), change)
    assert "PartitionFilters: [isnotnull(bucket" in plans[0] or "PartitionFilters: [(bucket" in plans[0] or "PartitionFilters: [bucket" in plans[0]


def test_a_change_may_not_put_other_members(spark, tmp_out):
    root = f"{tmp_out}/state"
    members = spark.createDataFrame([("1",)], "MEME_CK string")
    rows = spark.createDataFrame([_row(m, 1) for m in range(40)], STATE_SCHEMA)
    with pytest.raises(ValueError, match="doesn't name"):
        update_state(spark, root, members, lambda old: rows)
    assert read_state(spark, root).count() == 0


def test_slices_with_names_alike_stay_apart(spark, tmp_out):
    from enrollspark.sources.tables import read_slice, write_slice

    for state in ("01", "1", "1.0", "ALL"):
        write_slice(strings(spark, ["K"], [(state,)]), f"{tmp_out}/t", "V", "FULL", state)
    for state in ("01", "1", "1.0", "ALL"):
        assert [r["K"] for r in read_slice(spark, f"{tmp_out}/t", "V", "FULL", state).collect()] == [state]
    assert read_slice(spark, f"{tmp_out}/t", "V", "FULL", "2").count() == 0


def test_rows_appended_to_a_table_are_seen(spark, tmp_out):
    from enrollspark.sources import fixtures as fx

    s = spark.read.parquet("/root/testdata/sf0.001/supplier.parquet")
    s.write.parquet(f"{tmp_out}/supplier.parquet")
    n = fx.prpr(spark, tmp_out).count()
    s.write.mode("append").parquet(f"{tmp_out}/supplier.parquet")
    assert fx.prpr(spark, tmp_out).count() == 2 * n


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from enrollspark.session import shared_dir

    def session(master, folder=None):
        context = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: folder))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
        assert shared_dir(session(master, "hdfs:///shared")) == "hdfs:///shared"


def test_table_slices_are_read_by_partition_pruning(spark, tmp_out):
    from enrollspark.sources.tables import read_slice, write_slice

    a = strings(spark, ["K", "V"], [("1", "a"), ("2", "b")])
    b = strings(spark, ["K", "V"], [("3", "c")])
    write_slice(a, f"{tmp_out}/elig", "V", "FULL", "DC")
    write_slice(b, f"{tmp_out}/elig", "V", "CHANGE", "DC")
    write_slice(strings(spark, ["K", "V"], [("9", "z")]), f"{tmp_out}/elig", "V", "FULL", "DC")  # replaces FULL only
    sl = read_slice(spark, f"{tmp_out}/elig", "V", "CHANGE", "DC")
    assert sl.columns == ["K", "V"]
    assert [tuple(r) for r in sl.collect()] == [("3", "c")]
    assert [tuple(r) for r in read_slice(spark, f"{tmp_out}/elig", "V", "FULL", "DC").collect()] == [("9", "z")]
    plan = sl._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(vendor" in plan and "(mode" in plan


def test_read_input_names_missing_layout_columns(spark, tmp_out):
    from enrollspark.sources import fixtures as fx
    from enrollspark.sources.delimited import input_path, layout_path, read_input

    d = "/root/testdata/sf0.001"
    elig = fx.elig(spark, d).drop("CM_MEPE_ELIG_IND", "CM_PRPR_NAME")
    write_delimited(elig, input_path(f"{tmp_out}/s", "V", "FULL", "DC", "ELIG"), layout_path(f"{tmp_out}/l", "ELIG"))
    with pytest.raises(ValueError, match="lacks columns: CM_MEPE_ELIG_IND, CM_PRPR_NAME"):
        read_input(spark, f"{tmp_out}/l", f"{tmp_out}/s", "V", "FULL", "DC", "ELIG")


def test_checked_lines_are_judged_whole_where_one_column_is_used(spark, tmp_out):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from enrollspark.sources.delimited import read_checked

    spark.createDataFrame([("1|a|b",), ("2|a",), ("3|a|b|c",), ("4||",)], "value string").write.option("compression", "lz4").text(tmp_out)
    obs = Observation("lines")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("k", "x", "y")])
    got = read_checked(spark, tmp_out, schema, obs).agg(F.sum(F.col("k").cast("long"))).first()[0]
    assert got == 10 and obs.get == {"lines": 4, "short": 1, "surplus": 1}


def test_malformed_lines_stages_counts_not_rows(spark):
    import glob

    from conftest import SF_SMALL
    from enrollspark.plans.queries import QUERIES
    from enrollspark.session import shared_dir

    where = f"{shared_dir(spark).removeprefix('file:')}/malformed-*/rows"
    before = set(glob.glob(where))
    QUERIES["malformed_lines"](spark, SF_SMALL)
    new = set(glob.glob(where)) - before
    assert len(new) == 3 and all(spark.read.parquet(p).count() == 1 for p in new)


def test_compressed_delimited_files_hold_so_many_lines_and_read_back(spark, tmp_out):
    rows = [(str(k), None if k % 3 == 0 else f' {k} | "q" ') for k in range(100)]
    df = strings(spark, ["A", "B"], rows).coalesce(1)
    write_delimited(df, f"{tmp_out}/text", f"{tmp_out}/layout", compression="lz4", lines=30)
    back = read_delimited(spark, f"{tmp_out}/text", layout_schema(spark, f"{tmp_out}/layout"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    names = [f.rsplit("/", 1)[-1] for f in back.inputFiles()]
    assert len(names) == 4 and all(n.endswith(".csv.lz4") for n in names)


def test_the_roundtrip_leaves_compressed_text(spark):
    from conftest import SF_SMALL
    from enrollspark.plans.queries import QUERIES

    read = [f for f in QUERIES["delimited_roundtrip"](spark, SF_SMALL).inputFiles() if ".csv" in f]
    assert read and all(f.endswith(".csv.gz") for f in read)
