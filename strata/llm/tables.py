"""Reading inputs and writing intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.plans.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage: what reads the result never runs ``df`` again, and a
    lost executor loses none of it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 500_000


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows (counted, not estimated), else as it is.

    For the narrow side of a join: ids and flags. Give it a written table, so
    that counting reads only that.
    """
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
