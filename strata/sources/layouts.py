"""Table layouts that spare later jobs a shuffle or a sort.

* *Buckets*: rows hashed by a key into a fixed number of files, sorted inside.
  Two tables with the same buckets join, and a bucketed table groups by its
  key, without an exchange. Bucketing lives in a catalog entry, not in the
  files; the entry is made again from the files' folder when a session lacks
  it, so a bucketed table can be passed around as a path like any other.
* *Order*: rows split by sampled key ranges and sorted inside, so the files,
  one after the other, are the table in its total order.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from strata.sources.sinks import count_rows, write_table

_SPEC = "_BUCKETS"


def _spec_file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{_SPEC}")
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _entry(path: str) -> str:
    """Catalog name of the bucketed table in ``path``."""
    return f"strata_buckets_{hashlib.md5(path.rstrip('/').encode(), usedforsecurity=False).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, column: str, buckets: int) -> int:
    """Writes ``df`` in ``buckets`` files by the hash of ``column``, sorted by it; returns the rows written.

    For tables that have few rows per key (sums, one row per business): all rows of
    a key are one file, and a hot key would be one task.
    """
    spark, name = df.sparkSession, _entry(path)
    spark.sql(f"drop table if exists {name}")  # the entry only: its location is given, so files are not the catalog's
    counted, observed = count_rows(df.repartition(buckets, column))
    writer = counted.write.mode("overwrite").format("parquet").bucketBy(buckets, column).sortBy(column)
    writer.option("path", path).saveAsTable(name)
    p, fs = _spec_file(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps({"column": column, "buckets": buckets}).encode()))
    finally:
        out.close()
    return int(observed.get["rows"])


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of :func:`write_bucketed`, with its buckets known to the planner."""
    name = _entry(path)
    if not spark.catalog.tableExists(name):
        p, fs = _spec_file(spark, path)
        stream = fs.open(p)
        try:
            spec = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        by = f"clustered by (`{spec['column']}`) sorted by (`{spec['column']}`) into {spec['buckets']} buckets"
        spark.sql(f"create table {name} ({columns}) using parquet {by} location '{path}'")
    return spark.table(name)


def write_ordered(df: DataFrame, path: str, keys: Sequence[str], files: int) -> int:
    """Writes ``df`` so that its files in name order are the rows in the order of ``keys``; returns the rows written.

    Ranges are sampled over all keys, so rows of a hot first key spread over
    several files as long as the keys together tell them apart.
    """
    return write_table(df.repartitionByRange(files, *keys).sortWithinPartitions(*keys), path)


def ordered_files(spark: SparkSession, path: str) -> list[str]:
    """Data files of a table of :func:`write_ordered`, in the table's order."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")]
    return [f.toString() for f in sorted(found, key=lambda f: f.getName())]


def read_ordered(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """The rows in order, without a sort: a scan per file, one after the other; ``first`` takes that many files.

    A whole table is better read in any order by ``spark.read.parquet``; this is
    for a result that is shown or exported from its beginning.
    """
    files = ordered_files(spark, path)[:first]
    if not files:
        return spark.read.parquet(path)
    return reduce(DataFrame.union, [spark.read.parquet(f) for f in files])
