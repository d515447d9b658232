"""One file written and read by several tasks."""

import datetime as dt
import glob

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from enrollspark.plans import extract as ex
from enrollspark.plans.queries import _file_lines
from enrollspark.sources import fixtures as fx
from enrollspark.sources.joined import archive_path, join_files


def files(path):
    return sorted(glob.glob(f"{path.removeprefix('file:')}/part-*"))


def written(spark, path, as_of=fx.AS_OF, **how):
    d = SF_SMALL
    bodies = ex.record_bodies(fx.demo(spark, d), fx.elig(spark, d), as_of)
    return ex.write_extract(bodies, fx.prpr(spark, d), fx.prrg(spark, d), path, **how)


@pytest.mark.parametrize("compression", ["lz4", "gzip", "none"])
def test_one_file_is_written_and_read_by_several_tasks(spark, tmp_out, compression):
    """Before, one task wrote the file, and one, twice, read it."""
    whole, one = f"{tmp_out}/whole", f"{tmp_out}/one.har"
    n = written(spark, whole)
    want = [r["value"] for f in files(whole) for r in spark.read.text(f).collect()]
    assert written(spark, one, single_file=True, compression=compression, lines=50) == n == len(want)
    assert len(files(one)) == len(spark.read.text(one).inputFiles()) == 1
    assert [r["value"] for r in spark.read.text(one).coalesce(1).collect()] == want
    lines = _file_lines(spark, archive_path(spark, one), n)
    assert [(r["line_no"], r["rec_type"]) for r in lines.sort("line_no").collect()] == [*enumerate(want, 1)]
    assert lines.select(F.spark_partition_id()).distinct().count() > 1
    assert len(spark.read.text(archive_path(spark, one)).inputFiles()) >= n / 50


def test_a_first_part_without_lines_does_not_end_the_file(spark, tmp_out):
    parts, one = f"{tmp_out}/parts", f"{tmp_out}/one.har"
    spark.range(0, 40, 1, 4).filter("id >= 20").selectExpr("concat('line ', id) AS value").write.option("compression", "lz4").text(parts)
    assert len(files(parts)) == 3
    join_files(spark, parts, one)
    want = [f"line {k}" for k in range(20, 40)]
    assert [r["value"] for r in spark.read.text(one).collect()] == want
    assert sorted(r["value"] for r in spark.read.text(archive_path(spark, one)).collect()) == want


def test_an_empty_extract_is_one_empty_file_and_replaces_the_old_one(spark, tmp_out):
    one = f"{tmp_out}/one.har"
    assert written(spark, one, single_file=True, compression="lz4") > 0
    assert written(spark, one, dt.date(1900, 1, 1), single_file=True, compression="lz4") == 0
    assert len(files(one)) == 1 and spark.read.text(one).count() == 0
    assert _file_lines(spark, archive_path(spark, one), 0).count() == 0
