from pyspark.sql import types as T


def strings(spark, cols, rows):
    """DataFrame of nullable string columns."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    return spark.createDataFrame([tuple(r) for r in rows], schema)


ELIG_MIN = ["CM_ELIG_MEME_CK", "CM_ELIG_GRGR_CK", "CM_ELIG_EFF_DT", "CM_ELIG_TERM_DT", "CM_MEPE_ELIG_IND",
            "CM_MECD_MCTR_AIDC", "TAG"]
DEMO_MIN = ["CM_DEMO_MEME_CK", "CM_DEMO_GRGR_CK", "DTAG"]
