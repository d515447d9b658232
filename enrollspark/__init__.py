"""enrollspark — outbound membership-eligibility extracts as PySpark DataFrame jobs.

Every operator takes DataFrames and returns a DataFrame built from built-in
``pyspark.sql.functions`` expressions, so Catalyst plans the whole extract and
nothing passes through the driver.
"""

__version__ = "0.1.0"
