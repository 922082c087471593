"""Layered review analytics on Spark: bronze, silver and gold Parquet tables.

Every operator is a ``DataFrame -> DataFrame`` function built from the public
DataFrame API; the caller owns the SparkSession.
"""

__version__ = "0.1.0"
