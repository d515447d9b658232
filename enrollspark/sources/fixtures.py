"""Entities of the extract derived from the driver's test tables (FIXTURES.md §2).

The reference reads pipe-delimited member files whose columns are all strings.
These builders give the same shape from the parquet test tables with pure
column expressions, so every query's work grows with the tables. The DuckDB
twin of each builder lives in :mod:`enrollspark.oracle`.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from enrollspark.functions.text import blank_to_empty, parse_ymd, row_key

# The run date of the fixtures and the member subset of the change run.
AS_OF = _dt.date(1998, 7, 1)
CHANGE_MEMBER_MOD, CHANGE_MEMBER_REM = 4, 1
STATE_ORDER_MOD = 3
TWIN_ORDER_MOD, TWIN_ORDER_REM = 50, 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as it lies; Spark plans the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _ymd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def _sbsb(custkey: str) -> Column:
    # two members per subscriber
    return F.concat(F.lit("S"), F.lpad(_s(F.floor(F.col(custkey) / 2)), 8, "0"))


def _group_id(nationkey: str) -> Column:
    return F.concat(F.lpad(_s(nationkey), 2, "0"), F.lit("GRP"))


def demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEMO file: one row per member and group (from ``customer``)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.lit("DEMO").alias("RECORD_TYPE"),
        _s(k).alias("CM_DEMO_MEME_CK"),
        _s("c_nationkey").alias("CM_DEMO_GRGR_CK"),
        _sbsb("c_custkey").alias("CM_DEMO_SBSB_ID"),
        _group_id("c_nationkey").alias("CM_DEMO_GRGR_ID"),
        F.col("c_mktsegment").alias("CM_DEMO_MECD_MDCT"),
        F.concat(F.lit("MCD"), _s(k)).alias("CM_MEME_MEDCD_NO"),
        F.lit(None).cast("string").alias("CM_MEME_HICN"),
        _s(k).alias("CM_MEME_RECORD_NO"),
        F.lit(None).cast("string").alias("CM_MEME_FAM_LINK_ID"),
        F.col("c_name").alias("CM_MEME_LAST_NAME"),
        F.col("c_mktsegment").alias("CM_MEME_FIRST_NAME"),
        F.substring("c_name", 1, 1).alias("CM_MEME_MID_INIT"),
        F.lit(None).cast("string").alias("CM_MEME_TITLE"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.lpad(_s(k), 9, "0")).alias("CM_MEME_SSN"),
        F.when(k % 4 == 0, F.lit(""))
        .when(k % 4 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("55512"), F.lpad(_s(k), 5, "0")))
        .alias("CM_SBAD_PHONE_HOME"),
        F.lit(None).cast("string").alias("CM_MEME_WRK_PHONE"),
        F.lit(None).cast("string").alias("CM_MEME_CELL_PHONE"),
        F.col("c_mktsegment").alias("CM_SBAD_ADDR1_HOME"),
        F.lit(None).cast("string").alias("CM_SBAD_ADDR2_HOME"),
        F.concat(F.lit("CITY "), _s("c_nationkey")).alias("CM_SBAD_CITY_HOME"),
        F.lit("DC").alias("CM_SBAD_STATE_HOME"),
        F.lpad(_s(k), 5, "0").alias("CM_SBAD_ZIP_HOME"),
        F.lit("19800101").alias("CM_MEME_BIRTH_DT"),
        F.when(k % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("CM_MEME_SEX"),
        F.lit("ENG").alias("CM_MEME_MCTR_LANG"),
        F.when(k % 5 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("CM_ELIG_IND"),
        F.when(k % 6 == 0, F.lit("17530101")).otherwise(F.lit("20000101")).alias("CM_MEME_QUALIFY_DT"),
        F.lit(None).cast("string").alias("CM_SBAD_ADDR1_MAIL"),
        F.lit(None).cast("string").alias("CM_SBAD_ADDR2_MAIL"),
        F.lit(None).cast("string").alias("CM_SBAD_CITY_MAIL"),
        F.lit(None).cast("string").alias("CM_SBAD_STATE_MAIL"),
        F.lit(None).cast("string").alias("CM_SBAD_ZIP_MAIL"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.lit(None)).cast("string").alias("CM_MEME_HIST_LINK_ID"),
        F.when(k % 9 == 0, F.lit("19530101"))
        .when(k % 9 == 1, F.lit("17530101"))
        .when(k % 9 == 2, F.lit(None))
        .otherwise(F.lit("20300101"))
        .alias("CM_SBSB_RETIRE_DT"),
        F.lit("S").alias("CM_MEME_MARITAL_STATUS"),
        F.lit(None).cast("string").alias("CM_SBSB_MCTR_VIP"),
    )


def _elig_rows(orders: DataFrame, customer: DataFrame) -> DataFrame:
    o = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    ok = F.col("o_orderkey")
    odate = F.to_date("o_orderdate")
    term = (
        F.when(ok % 97 == 0, F.lit("20240231"))
        .when(ok % 89 == 0, F.lit(""))
        .otherwise(_ymd(F.date_add(odate, (F.lit(30) + ok % 720).cast("int"))))
    )
    prov = _s(ok % 120)
    return o.select(
        F.col("o_orderkey"),
        F.lit("ELIG").alias("RECORD_TYPE"),
        _sbsb("o_custkey").alias("CM_ELIG_SBSB_ID"),
        _s("o_custkey").alias("CM_ELIG_MEME_CK"),
        F.when(ok % 17 == 0, F.lit("X")).otherwise(_s("c_nationkey")).alias("CM_ELIG_GRGR_CK"),
        F.when(ok % 19 == 0, F.concat(_ymd(odate), F.lit("  "))).otherwise(_ymd(odate)).alias("CM_ELIG_EFF_DT"),
        F.when(ok % 23 == 0, F.concat(term, F.lit(" "))).otherwise(term).alias("CM_ELIG_TERM_DT"),
        F.when(F.col("o_orderstatus") == "P", F.lit("N")).otherwise(F.lit("Y")).alias("CM_MEPE_ELIG_IND"),
        F.when(ok % 11 == 0, F.lit("  "))
        .when(ok % 13 == 0, F.lit(None))
        .otherwise(F.col("o_orderpriority"))
        .alias("CM_MEPE_FI"),
        F.concat(F.lit("CSPI"), _s(ok % 9)).alias("CM_CSPI_ID"),
        F.when(ok % 10 == 0, F.lit(None)).otherwise(F.concat(F.lit("SG"), _s(ok % 4))).alias("CM_SGSG_ID"),
        _group_id("c_nationkey").alias("CM_GRGR_ID"),
        F.concat(F.lit("CS"), _s(ok % 5)).alias("CM_CSCS_ID"),
        F.concat(F.lit("PD"), _s(ok % 13)).alias("CM_PDPD_ID"),
        _group_id("c_nationkey").alias("CM_ELIG_GRGR_ID"),
        F.when(ok % 4 == 0, F.lit(None))
        .when(ok % 4 == 1, F.lit("P"))
        .when(ok % 4 == 2, F.lit("G"))
        .otherwise(F.lit(" P "))
        .alias("CM_PRPR_ENTITY"),
        F.col("c_name").alias("CM_PRCP_LAST_NAME"),
        F.col("c_mktsegment").alias("CM_PRCP_FIRST_NAME"),
        F.lit(None).cast("string").alias("CM_PRCP_MID_INIT"),
        F.concat(F.lit("CLINIC "), prov).alias("CM_PRPR_NAME"),
        F.concat(F.lit("P"), prov).alias("CM_PRPR_ID"),
        F.lpad(prov, 10, "0").alias("CM_PRPR_NPI"),
        F.lit(None).cast("string").alias("CM_PCP_TIN"),
        F.concat(F.lit("A"), _s(ok % 10)).alias("CM_MECD_MCTR_AIDC"),
        F.col("o_orderpriority").alias("CM_ELIG_MECD_MDCT"),
        F.concat(F.lit("ADDR "), prov).alias("CM_PRAD_ADDR1"),
        F.lit(None).cast("string").alias("CM_PRAD_ADDR2"),
        F.lit("CITY").alias("CM_PRAD_CITY"),
        F.lpad(_s("c_nationkey"), 2, "0").alias("CM_PRAD_STATE"),
        F.lpad(_s(ok % 100000), 5, "0").alias("CM_PRAD_ZIP"),
        F.lit("USA").alias("CM_PRAD_CTRY_CD"),
        F.concat(F.lit("CLINIC "), prov).alias("CM_PRPR_CLINIC_NAME"),
        F.lit(None).cast("string").alias("CM_PCP_CLINIC_TIN"),
    )


def elig_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ELIG spans without twins, keeping ``o_orderkey`` (from ``orders`` ⋈ ``customer``)."""
    return _elig_rows(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"),
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name", "c_mktsegment"),
    )


def elig(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ELIG file: one row per span plus an ``'N'`` twin of every fiftieth order's span."""
    rows = elig_base(spark, sf_dir)
    is_twin_source = F.col("o_orderkey") % TWIN_ORDER_MOD == TWIN_ORDER_REM
    copies = F.when(is_twin_source, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    out = rows.withColumn("_twin", F.explode(copies))
    out = out.withColumn("CM_MEPE_ELIG_IND", F.when(F.col("_twin"), F.lit("N")).otherwise(F.col("CM_MEPE_ELIG_IND")))
    return out.drop("o_orderkey", "_twin")


def prpr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider table (from ``supplier``)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    return s.select(
        F.concat(F.lit("P"), _s("s_suppkey")).alias("PRPR_ID"),
        F.concat(F.lit("C"), _s(F.col("s_suppkey") % 70)).alias("PRCR_ID"),
    )


def prrg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider registration history (from ``part``)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    k = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("C"), _s(k % 60)).alias("PRCR_ID"),
        F.when(k % 7 == 0, F.lit("NP")).when(k % 7 == 1, F.lit("MD ")).otherwise(F.lit("MD")).alias("PRRG_MCTR_TYPE"),
        F.when(k % 31 == 0, F.lit(None)).when(k % 29 == 0, F.lit("n/a")).otherwise(_s("p_size")).alias("PRRG_SEQ_NO"),
        F.when(k % 37 == 0, F.lit(None)).otherwise(F.concat(F.lit("M"), _s(k))).alias("PRRG_ID"),
    )


def cob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COB file: one row per order line (from ``lineitem`` ⋈ ``orders``)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    ship = F.to_date("l_shipdate")
    return j.select(
        F.lit("COB").alias("RECORD_TYPE"),
        _s("o_custkey").alias("CM_COB_MEME_CK"),
        _sbsb("o_custkey").alias("CM_COB_SBSB_ID"),
        F.concat(F.lpad(_s(F.col("o_custkey") % 25), 2, "0"), F.lit("GRP")).alias("CM_COB_GRGR_ID"),
        _ymd(ship).alias("CM_COB_EFF_DT"),
        _ymd(F.date_add(ship, 365)).alias("CM_COB_TERM_DT"),
        _s("l_partkey").alias("CM_CARRIER_ID"),
        F.col("l_returnflag").alias("CM_COB_INSUR_TYPE"),
        F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("CM_COB_POLICY_ID"),
        F.concat(F.lit("CARRIER "), _s(F.col("l_partkey") % 50)).alias("CM_MCRE_NAME"),
        F.lit("1 MAIN ST").alias("CM_MCRE_ADDR1"),
        F.lit(None).cast("string").alias("CM_MCRE_ADDR2"),
        F.lit("CITY").alias("CM_MCRE_CITY"),
        F.lit("DC").alias("CM_MCRE_STATE"),
        F.lpad(_s(F.col("l_partkey") % 100000), 5, "0").alias("CM_MCRE_ZIP"),
        F.lit(None).cast("string").alias("CM_MCRE_PHONE"),
    )


def span_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prior span state: every third order's span, one row per member and effective date."""
    e = elig_base(spark, sf_dir).filter(F.col("o_orderkey") % STATE_ORDER_MOD == 0)
    w = Window.partitionBy("CM_ELIG_MEME_CK", "CM_ELIG_EFF_DT").orderBy("o_orderkey")
    first = e.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1)
    return first.select(
        row_key("CM_ELIG_MEME_CK", "CM_ELIG_EFF_DT").alias("row_key"),
        F.col("CM_ELIG_MEME_CK").alias("MEME_CK"),
        parse_ymd("CM_ELIG_EFF_DT").alias("MEPE_EFF_DT"),
        parse_ymd("CM_ELIG_TERM_DT").alias("MEPE_TERM_DT"),
        blank_to_empty("CM_CSPI_ID").alias("CSPI_ID"),
        blank_to_empty("CM_SGSG_ID").alias("SGSG_ID"),
        blank_to_empty("CM_CSCS_ID").alias("CSCS_ID"),
        blank_to_empty("CM_MEPE_FI").alias("MEPE_FI"),
        blank_to_empty("CM_PDPD_ID").alias("PDPD_ID"),
    )


def change_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEMO file of a change run: the members with ``c_custkey % 4 = 1``."""
    d = demo(spark, sf_dir)
    return d.filter(F.col("CM_DEMO_MEME_CK").cast("long") % CHANGE_MEMBER_MOD == CHANGE_MEMBER_REM)


def change_elig(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ELIG file of a change run: every span of the changed members."""
    e = elig(spark, sf_dir)
    return e.filter(F.col("CM_ELIG_MEME_CK").cast("long") % CHANGE_MEMBER_MOD == CHANGE_MEMBER_REM)


def change_cob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COB file of a change run: the COB rows of the changed members."""
    c = cob(spark, sf_dir)
    return c.filter(F.col("CM_COB_MEME_CK").cast("long") % CHANGE_MEMBER_MOD == CHANGE_MEMBER_REM)


def static_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static list of state ids: one per nation plus one per region (the latter never has members)."""
    n = table(spark, sf_dir, "nation").select(F.lpad(_s("n_nationkey"), 2, "0").alias("STATE_ID"))
    r = table(spark, sf_dir, "region").select(F.concat(F.lit("9"), _s("r_regionkey")).alias("STATE_ID"))
    return n.unionByName(r)


def member_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member-span reason table: every order gives its member a reason code."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return o.select(
        _s("o_custkey").alias("MEME_CK"),
        F.to_date("o_orderdate").alias("MEPE_EFF_DT"),
        F.concat(F.lit("R"), _s(F.col("o_orderkey") % 4)).alias("MEPE_MCTR_RSN"),
    )
