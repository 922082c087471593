"""Incremental bronze load with Structured Streaming.

The batch load rewrites a bronze table from the whole raw folder. This is the
same load for a raw folder that keeps receiving new dumps: a file source
picks up only files it has not seen, the Parquet sink appends them, and the
checkpoint plus the sink's commit log make each file land exactly once, even
if executors or the driver die mid-way. ``availableNow`` processes what is
there now (in bounded batches) and stops, so it runs as a scheduled batch job.

Batch readers of the bronze folder see only committed files (the sink's
``_spark_metadata`` log), never a half-written batch.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.sources.bronze import with_ingest_metadata
from strata.sources.raw import CORRUPT, RAW_SCHEMAS


def start_bronze_stream(
    spark: SparkSession,
    raw_dir: str,
    bronze_path: str,
    checkpoint: str,
    dataset: str,
    schema: str | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start an ``availableNow`` stream raw JSON folder -> bronze Parquet.

    A streaming file source needs a declared schema; the dataset's entry in
    :data:`RAW_SCHEMAS` is used when none is given. ``source_file`` is the
    file each row came from.
    """
    src = (
        spark.readStream.schema(schema or RAW_SCHEMAS[dataset])
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(raw_dir)
    )
    return (
        with_ingest_metadata(src)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(bronze_path)
    )


def ingest_available(
    spark: SparkSession,
    raw_dir: str,
    bronze_path: str,
    checkpoint: str,
    dataset: str,
    schema: str | None = None,
) -> None:
    """Ingest every raw file not yet in bronze, then return."""
    q = start_bronze_stream(spark, raw_dir, bronze_path, checkpoint, dataset, schema)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"bronze stream for {dataset} failed") from q.exception()
