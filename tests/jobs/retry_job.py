"""Run the one-file extract twice, once with the first attempt of a final-stage task failing,
and print whether the two outputs are identical (run by tests/test_retry.py in its own JVM)."""

import glob
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from enrollspark.plans.extract import build_extract, write_records  # noqa: E402
from enrollspark.sources import fixtures as fx  # noqa: E402


@F.udf(T.BooleanType())
def fail_first_attempt(_):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
        raise RuntimeError("injected task failure")
    return True


def lines(path):
    path = path.removeprefix("file:")
    out = []
    for p in sorted(glob.glob(f"{path}/part-*")):
        with open(p, encoding="utf-8") as f:
            out.extend(f.read().splitlines())
    return out


def main():
    spark = (
        SparkSession.builder.master("local[4,3]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("WARN")  # task losses are logged at WARN
    d = sys.argv[1]
    out = tempfile.mkdtemp(prefix="enrollspark-retry-")
    recs = build_extract(fx.demo(spark, d), fx.elig(spark, d), fx.prpr(spark, d), fx.prrg(spark, d), fx.AS_OF)
    n1 = write_records(recs, f"{out}/clean", single_file=True)
    n2 = write_records(recs.filter(fail_first_attempt(F.col("SBSB_ID"))), f"{out}/retried", single_file=True)
    print("RESULT", n1, n2, lines(f"{out}/clean") == lines(f"{out}/retried"))
    spark.stop()


if __name__ == "__main__":
    main()
