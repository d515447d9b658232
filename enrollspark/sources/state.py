"""Span state as a plain Parquet table partitioned by member bucket (SRC-5, SNK-2/3).

A change run reads the buckets of its members, applies the change, stages the result and
overwrites those partitions (Spark's dynamic partition overwrite); all other partitions
keep their files, so its cost follows the change. One writer at a time: Spark's file
commit doesn't arbitrate between two. A run that dies before its overwrite leaves the
table as it was; one that dies within it is mended by running the same change again,
which gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrollspark.session import remove_path, scratch_path

BUCKETS = 64  # one number for the life of a table

STATE_SCHEMA = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("MEME_CK", T.StringType()),
        T.StructField("MEPE_EFF_DT", T.DateType()),
        T.StructField("MEPE_TERM_DT", T.DateType()),
        T.StructField("CSPI_ID", T.StringType()),
        T.StructField("SGSG_ID", T.StringType()),
        T.StructField("CSCS_ID", T.StringType()),
        T.StructField("MEPE_FI", T.StringType()),
        T.StructField("PDPD_ID", T.StringType()),
    ]
)
COLUMNS = STATE_SCHEMA.fieldNames()
_TABLE_SCHEMA = T.StructType([*STATE_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])


def bucket_of(member: str = "MEME_CK", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(member), F.lit(buckets)).cast("int")


def _table(root: str) -> str:
    return f"{root.rstrip('/')}/spans"


def _buckets(spark: SparkSession, root: str) -> DataFrame:
    """The table's rows with their bucket; none where no state was written yet.

    A row without key and member stands for a bucket that a change emptied.
    """
    try:
        rows = spark.read.schema(_TABLE_SCHEMA).parquet(_table(root))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in _TABLE_SCHEMA])
    return rows.filter(F.col("row_key").isNotNull() | F.col("MEME_CK").isNotNull())


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """The state's rows; an empty state when there is none."""
    return _buckets(spark, root).select(*COLUMNS)


def _write(rows: DataFrame, root: str, how: str) -> None:
    """Write rows with their bucket; a bucket's rows meet in few files, and Spark splits a partition that grows too large."""
    out = rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", how)
    out.partitionBy("bucket").parquet(_table(root))


def write_state(state: DataFrame, root: str, buckets: int = BUCKETS) -> None:
    """Replace the whole state."""
    _write(state.select(*COLUMNS, bucket_of(buckets=buckets).alias("bucket")), root, "static")


def update_state(spark: SparkSession, root: str, members: DataFrame, change: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> int:
    """Rewrite the buckets of ``members`` (column MEME_CK) by ``change``; the number of buckets rewritten.

    ``change`` gets the rows of those buckets and returns what they hold afterwards. The
    result is staged before the table is touched, as it is made from the partitions that it
    replaces. Rows of members in other buckets are an error.
    """
    touched = sorted(r["b"] for r in members.select(bucket_of(buckets=buckets).alias("b")).distinct().collect())  # one row for each bucket
    if not touched:
        return 0
    now = _buckets(spark, root).filter(F.col("bucket").isin(touched)).select(*COLUMNS)
    path = scratch_path(spark, "state")
    change(now).select(*COLUMNS, bucket_of(buckets=buckets).alias("bucket")).write.parquet(path)
    after = spark.read.schema(_TABLE_SCHEMA).parquet(path)
    filled = {r["bucket"] for r in after.select("bucket").distinct().collect()}
    if filled - set(touched):
        remove_path(spark, path)
        raise ValueError("a change may not put rows of members that it doesn't name")
    # an overwrite leaves a partition alone that it has no row for
    empty = spark.createDataFrame([(None,) * len(COLUMNS) + (b,) for b in touched if b not in filled], _TABLE_SCHEMA)
    _write(after.unionByName(empty), root, "dynamic")
    remove_path(spark, path)
    return len(touched)
