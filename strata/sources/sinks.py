"""Parquet sinks.

Flat tables are written as they come. A partitioned table goes through
Spark's REBALANCE on the partition columns: rows of one partition value meet
in as few tasks as possible (few files per directory), while adaptive
execution splits a value that is too big for one task and merges small ones,
so one hot week never lands on a single writer.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def count_rows(df: DataFrame, **measures: Column) -> tuple[DataFrame, Observation]:
    """``df`` and what will know its rows once it is written: counted in the writing stage itself, without a second job."""
    obs = Observation()
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in measures.items()]), obs


def bloom_filter_options(columns: Sequence[str]) -> dict[str, str]:
    """Parquet writer options for a bloom filter on each of ``columns``.

    An equality filter on such a column then skips every row group whose
    filter rules the value out, which min/max statistics cannot do for a
    column the file is not sorted by. The adaptive filter is sized from the
    distinct values actually seen, so a small row group gets a small filter.
    """
    if not columns:
        return {}
    opts = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    opts["parquet.bloom.filter.adaptive.enabled"] = "true"
    return opts


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", bloom_filter_columns: Sequence[str] = ()
) -> int:
    """Write Parquet; returns the number of rows written."""
    out, obs = count_rows(df)
    out.write.mode(mode).options(**bloom_filter_options(bloom_filter_columns)).parquet(path)
    return int(obs.get["rows"])


def staged(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table in the new folder ``path``: not computed for each use, and its shuffles are over before those of what follows."""
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_measured(df: DataFrame, path: str, mode: str = "overwrite", **measures: Column) -> dict[str, int]:
    """Write Parquet; returns ``rows`` and the given aggregates, all taken during the write."""
    out, obs = count_rows(df, **measures)
    out.write.mode(mode).parquet(path)
    return {k: int(v) for k, v in obs.get.items()}


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
    bloom_filter_columns: Sequence[str] = (),
) -> int:
    """Hive-style partitioned Parquet; files sorted by ``cluster_by`` inside each directory.

    Returns the number of rows written.
    """
    cols = list(partition_by)
    laid_out, obs = count_rows(df.hint("rebalance", *cols).sortWithinPartitions(*cols, *cluster_by))
    writer = laid_out.write.mode(mode).partitionBy(*cols).options(**bloom_filter_options(bloom_filter_columns))
    writer.parquet(path)
    return int(obs.get["rows"])


def replace_partitions(
    df: DataFrame,
    path: str,
    column: str,
    values: Sequence[str],
    cluster_by: Sequence[str] = (),
    bloom_filter_columns: Sequence[str] = (),
) -> int:
    """Replaces the partitions ``values`` (as text) of a table partitioned by ``column`` with ``df``'s rows of them.

    Other partitions, their files included, stay as they are. A replaced
    partition without rows in ``df`` goes, which an overwrite of partitions
    alone would leave as it was. The new files are written aside and moved in
    when all are complete. Returns the number of rows written.
    """
    if not values:
        return 0
    key = F.col(column).cast("string")
    some = df.where(key.isin(list(values))).hint("rebalance", column).sortWithinPartitions(column, *cluster_by)
    out, obs = count_rows(some, found=F.collect_set(key))
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column)
    writer.options(**bloom_filter_options(bloom_filter_columns)).parquet(path)
    got = obs.get
    _drop_partitions(df.sparkSession, path, column, set(values) - set(got["found"] or ()))
    return int(got["rows"])


def _drop_partitions(spark: SparkSession, path: str, column: str, values: set[str]) -> None:
    """Removes the folders of partitions that have no rows any more."""
    if not values:
        return
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for s in fs.listStatus(root):
        name, _, value = s.getPath().getName().partition("=")
        if name == column and unquote(value) in values:
            fs.delete(s.getPath(), True)
