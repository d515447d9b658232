"""Run inputs kept as tables: slices by vendor, mode and state (SRC-3, table form), tables
prepared for joins, and spans with typed dates.

A run's slice is a filter on the partition columns, which Spark answers by
partition pruning: only the slice's folders are listed and read. A prepared table is
bucketed and sorted by its join keys, so that joins of two of them need no exchange.
Spans with typed dates are sorted by them within a file, so that a run-date
test skips row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrollspark.operators.spans import EFF_DATE, TERM_DATE, typed_spans

PARTITION_COLS = ["vendor", "mode", "state"]


def write_slice(df: DataFrame, root: str, vendor: str, mode: str, state: str) -> None:
    """Replace one run's slice of an input table; dynamic partition overwrite leaves other slices alone."""
    tagged = df.select("*", F.lit(vendor).alias("vendor"), F.lit(mode).alias("mode"), F.lit(state).alias("state"))
    (
        tagged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLS)
        .parquet(root)
    )


def read_slice(spark: SparkSession, root: str, vendor: str, mode: str, state: str) -> DataFrame:
    """One run's slice of an input table, read through partition pruning; partition columns dropped.

    The partition columns are read as strings, so ``01`` and ``1`` are two slices.
    A slice that isn't there has no rows.
    """
    data = [f for f in spark.read.parquet(root).schema.fields if f.name not in PARTITION_COLS]
    schema = T.StructType([*data, *(T.StructField(c, T.StringType()) for c in PARTITION_COLS)])
    df = spark.read.schema(schema).parquet(root)
    sl = df.filter((F.col("vendor") == vendor) & (F.col("mode") == mode) & (F.col("state") == state))
    return sl.drop(*PARTITION_COLS)


def write_prepared(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Save ``df`` as a catalog table in ``buckets`` buckets by ``keys``, sorted by them, and return it.

    Tables that are joined on their keys, in this order, need the same number of buckets. A
    bucket is a task of the join; size the number so that one fits in an executor. Rows
    are dealt to their bucket's task before the write, so each bucket is one file.
    """
    out = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        out = out.option("path", path)
    out.saveAsTable(table)
    return df.sparkSession.read.table(table)


def write_spans(elig: DataFrame, path: str) -> DataFrame:
    """Write ELIG with typed dates (``typed_spans``), ranged and sorted by the last day and the first, and return the table.

    For any run date, spans that ended before it lie in row groups of their own, which
    the date test then skips.
    """
    typed = typed_spans(elig)
    typed.repartitionByRange(TERM_DATE, EFF_DATE).sortWithinPartitions(TERM_DATE, EFF_DATE).write.parquet(path)
    return elig.sparkSession.read.schema(typed.schema).parquet(path)
