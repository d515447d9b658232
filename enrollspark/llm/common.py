"""Shared helpers: tables, staging, distributed numbering, name-safe columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from enrollspark.session import shared_dir

# ASCII white space; words are the runs between it
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a new table in the shared folder and read it back.

    Cuts the lineage with files that every executor can read, so a lost executor
    costs a re-read only.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def private(df: DataFrame, *names: str) -> list[str]:
    """A column name for each of ``names`` that ``df`` doesn't have yet, in any letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"{n}_"
        taken.add(n.lower())
        out.append(n)
    return out


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def split_words(text: Column) -> Column:
    """The words of a text (null: none): runs of characters other than ASCII white space, in order."""
    t = F.btrim(text_or_empty(text), F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_CLASS + "+"))


def crc_bucket(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null id: of the empty text)."""
    return F.crc32(text_or_empty(id_col.cast("string"))) % mod


def filter_above(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on columns that ``df`` computes, without computing them twice.

    A plain filter is pushed below the projections, with the whole expression of every
    column written out once for each use. The row number, which is never negative,
    isn't deterministic to Spark, so the filter stays above it; the rows kept are the same.
    """
    (row,) = private(df, "row")
    return df.withColumn(row, F.monotonically_increasing_id()).filter(condition & (F.col(row) >= 0)).drop(row)


def row_salt() -> Column:
    """A hash of a row's file and place there: rows that are equal in all columns differ in it. For tables read from staged files only."""
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def deal(staged: DataFrame, keys: list[Column], rows: int, out: str) -> DataFrame:
    """Add ``out``, a number of a bucket of about ``rows`` rows: by the hash of ``keys``.

    A bucket of more than twice as many, as rows with equal keys make it, is dealt on by file
    and row, so no bucket is large whatever the rows hold. ``staged`` is read from files.
    """
    b, salt, n, parts = private(staged, f"{out}_hash", f"{out}_salt", f"{out}_of", f"{out}_parts")
    buckets = max(1, -(-staged.count() // rows))
    d = staged.select("*", F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias(b), row_salt().alias(salt))
    crowded = d.groupBy(F.col(b).alias(n)).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(parts)).filter(F.col(parts) > 2)
    if crowded.isEmpty():
        return d.withColumn(out, F.col(b)).drop(b, salt)
    d = d.join(crowded, F.col(b) == F.col(n), "left")
    return d.withColumn(out, F.col(b) + F.lit(buckets) * F.pmod(F.col(salt), F.coalesce(F.col(parts), F.lit(1)))).drop(b, salt, n, parts)


def number_rows(df: DataFrame, group: str, order: list[Column], out: str, rows_per_bucket: int = 4096) -> DataFrame:
    """Add ``out``: a gapless number from 0 within each ``group``, rows in ``order``.

    No group is gathered in one task, however large, nor are rows with equal keys: rows are dealt
    to buckets of bounded size (``deal``) by the
    hash of their order keys whatever their group, numbered by group in their bucket,
    and start after their group's rows in the buckets before. Rows with equal order keys
    are numbered in any way; the numbers of a group are in hash order, not key order.
    ``df`` is staged.
    """
    b, r, n, s = private(df, "bucket", "row", "rows", "start")
    d = deal(stage(df, "numbered"), order, rows_per_bucket, b)
    dealt = d.repartition(F.col(b))  # by bucket alone: a group's size makes no task larger
    w = Window.partitionBy(group, b).orderBy(*order)
    counts = d.groupBy(group, b).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias(f"{s}_g"), F.col(b).alias(f"{s}_b"), F.coalesce(F.sum(n).over(before), F.lit(0)).alias(s))
    return (
        dealt.withColumn(r, F.row_number().over(w) - 1)
        .join(starts, F.col(group).eqNullSafe(F.col(f"{s}_g")) & (F.col(b) == F.col(f"{s}_b")))
        .withColumn(out, F.col(s) + F.col(r))
        .drop(b, r, s, f"{s}_g", f"{s}_b")
    )
