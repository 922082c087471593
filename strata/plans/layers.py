"""Bronze -> silver -> gold, each stage reading back what the previous one wrote.

Reading back instead of reusing the lazy plan means no silver plan is ever
evaluated twice, the gold tables always agree with the silver files, and the
lineage of every stage starts at a durable table: a lost executor costs a
re-run of its tasks in the current stage, never a replay from raw JSON.

Independent tables of one layer are submitted as concurrent Spark jobs, so
small tables do not leave the cluster idle while a big one runs.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import gold
from strata.operators.silver import SPECS
from strata.operators.rules import clean
from strata.operators.two_pass import clean_two_pass
from strata.plans.session import (
    INITIAL_PARTITIONS,
    SPLIT_BYTES,
    freeing_session,
    input_bytes,
    layer_session,
    scratch_folder,
    shuffle_partitions_from_input,
)
from strata.sources.bronze import Limits, load
from strata.sources.raw import DATASETS, PACKED_SHRINK, RAW_FILE, RAW_SCHEMAS, packed, raw_path
from strata.sources.sinks import staged, write_partitioned, write_table
from strata.sources.versions import publish, read_table, resolve

log = logging.getLogger(__name__)

GOLD_TABLES = ("weekly_stars", "checkins_vs_stars")
BUSINESS_COLUMNS = ("business_id", "business_name", "city", "state", "stars", "review_count")  # what both gold tables read
GOLD_INPUTS = {"weekly_stars": ("review", "business"), "checkins_vs_stars": ("checkin", "business")}


@dataclass(frozen=True)
class Layout:
    """Folder layout: ``raw`` JSON in, ``root``/{bronze,silver,gold}/<table> out.

    A layer can live elsewhere by naming its folder (``bronze_root`` etc.).
    """

    root: str
    raw: str
    raw_pattern: str = RAW_FILE
    bronze_root: str | None = None
    silver_root: str | None = None
    gold_root: str | None = None

    def raw_file(self, name: str) -> str:
        return raw_path(self.raw, name, self.raw_pattern)

    def _layer(self, override: str | None, layer: str, name: str) -> str:
        base = override.rstrip("/") if override else f"{self.root}/{layer}"
        return f"{base}/{name}"

    def bronze(self, name: str) -> str:
        return self._layer(self.bronze_root, "bronze", name)

    def silver(self, name: str) -> str:
        return self._layer(self.silver_root, "silver", name)

    def gold(self, name: str) -> str:
        return self._layer(self.gold_root, "gold", name)


@dataclass(frozen=True)
class RunSpec:
    datasets: tuple[str, ...] = DATASETS
    declared_schemas: bool = False  # True skips the JSON inference pass
    # The analyses filter on year, so year directories are pruned by them;
    # files inside are sorted by week and business for row-group skipping.
    # ("review_week",) gives the one-directory-per-week layout.
    weekly_partition_by: tuple[str, ...] = ("review_year",)
    weekly_cluster_by: tuple[str, ...] = ("review_week", "business_id")
    # Lookups by business (one business's history) skip row groups through
    # these filters; the files are sorted by week, so statistics cannot.
    weekly_bloom_filters: tuple[str, ...] = ("business_id", "business_name")
    concurrent: bool = True
    # Bytes of raw JSON text per bronze task (and so per bronze file), set on the
    # bronze layer's own session; of compressed dumps so much less is read. JSON shrinks several times as Parquet, so 512 MiB of
    # text gives files near 100 MiB instead of many small ones; Spark still
    # splits small inputs finer to keep every core busy. None leaves the
    # session's spark.sql.files.maxPartitionBytes alone.
    raw_split_bytes: int | None = 512 * 1024 * 1024
    # Bytes of bronze Parquet per silver map task, set on the silver layer's
    # own session. The dedup shuffle has maps x reducers blocks, and reducers
    # are capped, so at scale fewer and larger map tasks are what keeps its
    # blocks from becoming tiny random reads. None leaves the session alone.
    silver_split_bytes: int | None = 512 * 1024 * 1024
    # Bytes of bronze from which a silver table is deduplicated in two passes,
    # so that only rows with a copy are shuffled; below, one pass has fewer
    # jobs. None always takes one.
    two_pass_bytes: int | None = 16 * 1024 * 1024 * 1024
    # Bytes of silver reviews, or of weekly sums, from which the weekly figures
    # are written and read back before they are joined with businesses: their shuffle
    # is then off the disks before the two that follow. None never does.
    staged_bytes: int | None = 128 * 1024 * 1024
    # Shares of corrupt rows and of rows with undeclared keys that fail a
    # bronze load; by default they are counted and logged.
    limits: Limits = Limits()
    # Keep silver.business with the executors while the two gold tables are
    # made, if it is small. Off: not shown to be faster than reading it twice.
    cache_business: bool = False
    # Write each table to a new version and switch to it when it is complete
    # (strata.sources.versions): readers and failed runs never see half a
    # table. Read such tables through versions.read_table.
    versioned: bool = False
    # Size the initial shuffle partition count of silver and gold from the
    # bytes of their inputs (changes a session setting, hence opt-in).
    size_shuffles: bool = False


# Thread-local job properties a caller may have set (group for cancelling,
# description, scheduler pool, tags); worker threads start without them.
_JOB_PROPERTIES = (
    "spark.jobGroup.id",
    "spark.job.description",
    "spark.job.interruptOnCancel",
    "spark.scheduler.pool",
    "spark.job.tags",
)


def _labelled(spark: SparkSession, layer: str, fn):
    """``fn`` with its Spark jobs described as "strata <layer> <table>".

    The caller's job group, pool and tags (read when this is called, in the
    caller's thread) are carried into the thread that runs ``fn``, so a
    caller can still cancel or route the layer's jobs; every property is
    restored afterwards.
    """
    try:
        sc = spark.sparkContext
        inherited = {k: sc.getLocalProperty(k) for k in _JOB_PROPERTIES}
    except Exception:  # Spark Connect: no SparkContext; jobs stay unlabelled
        return fn

    def run(item: str):
        before = {k: sc.getLocalProperty(k) for k in _JOB_PROPERTIES}
        for k, v in inherited.items():
            sc.setLocalProperty(k, v)
        outer = inherited["spark.job.description"]
        label = f"strata {layer} {item}"
        sc.setLocalProperty("spark.job.description", f"{outer}: {label}" if outer else label)
        try:
            return fn(item)
        finally:
            for k, v in before.items():
                sc.setLocalProperty(k, v)

    return run


def _unique(names) -> list[str]:
    """Each name once, in order: two jobs must never overwrite one folder at once."""
    return list(dict.fromkeys(names))


def _each(spark: SparkSession, fn, items, concurrent: bool) -> dict:
    """``fn`` for each item, at the same time if asked for; the first failure cancels the other items' Spark jobs."""
    if not concurrent or len(items) < 2:
        return {i: fn(i) for i in items}
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no job tags here
        sc = None
    tag = f"strata-{uuid.uuid4().hex}"

    def tagged(item):
        if sc is None:
            return fn(item)
        sc.addJobTag(tag)
        try:
            return fn(item)
        finally:
            sc.removeJobTag(tag)

    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        futures = {i: pool.submit(tagged, i) for i in items}
        done, _ = wait(futures.values(), return_when=FIRST_EXCEPTION)
        failed = next((f for f in futures.values() if f in done and f.exception()), None)
        if failed is not None:
            if sc is not None:
                sc.cancelJobsWithTag(tag)
            failed.result()
        return {i: f.result() for i, f in futures.items()}


def run_bronze(spark: SparkSession, layout: Layout, spec: RunSpec = RunSpec()) -> dict[str, int]:
    def one(name: str) -> int:
        split = spec.raw_split_bytes
        if split is not None and packed(spark, layout.raw_file(name)):
            split = max(1, split // PACKED_SHRINK)
        s = freeing_session(layer_session(spark, {SPLIT_BYTES: None if split is None else str(split)}))
        schema = RAW_SCHEMAS.get(name) if spec.declared_schemas else None
        return load(s, layout.raw_file(name), layout.bronze(name), schema, limits=spec.limits, versioned=spec.versioned).rows

    return _each(spark, _labelled(spark, "bronze", one), _unique(spec.datasets), spec.concurrent)


def put_table(spark: SparkSession, spec: RunSpec, table: str, write) -> int:
    """``write(folder)`` for a table in place, or for a new version of it."""
    return publish(spark, table, write) if spec.versioned else write(table)


def _sized(
    spark: SparkSession, spec: RunSpec, layer: str, inputs: list[str], split_bytes: int | None = None
) -> SparkSession:
    """The layer's session: its split size, and its initial shuffle count sized from ``inputs`` when asked."""
    settings = {SPLIT_BYTES: None if split_bytes is None else str(split_bytes)}
    if spec.size_shuffles:
        n = shuffle_partitions_from_input(spark, [resolve(spark, p) for p in inputs])
        log.info("%s: %s initial shuffle partitions", layer, n)
        settings[INITIAL_PARTITIONS] = None if n is None else str(n)
    return layer_session(spark, settings)


def run_silver(spark: SparkSession, layout: Layout, spec: RunSpec = RunSpec()) -> dict[str, int]:
    datasets = _unique(spec.datasets)
    s = freeing_session(_sized(spark, spec, "silver", [layout.bronze(d) for d in datasets], spec.silver_split_bytes))

    def one(name: str) -> int:
        source = resolve(s, layout.bronze(name))
        size = None if spec.two_pass_bytes is None else input_bytes(s, [source])
        with ExitStack() as scratch:
            if size is not None and size >= spec.two_pass_bytes:
                repeated = scratch.enter_context(scratch_folder(s, f"repeated-{name}"))
                out = clean_two_pass(s.read.parquet(source), SPECS[name], repeated)
            else:
                out = clean(s.read.parquet(source), SPECS[name])
            rows = put_table(s, spec, layout.silver(name), lambda path: write_table(out, path))
        log.info("cleaned %s: %d rows", name, rows)
        return rows

    return _each(spark, _labelled(spark, "silver", one), datasets, spec.concurrent)


def _count_column(dataset: str, column: str) -> str | None:
    """None (count rows) when the silver spec requires ``column``: the counts agree
    and the scan can skip the column; otherwise count its non-NULL values."""
    return None if column in SPECS[dataset].required else column


@contextmanager
def staging(spark: SparkSession, spec: RunSpec, label: str, inputs: list[str]) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What keeps a table for the ``with`` block, if ``inputs`` have ``spec.staged_bytes``; else it leaves DataFrames as they are."""
    size = None if spec.staged_bytes is None else input_bytes(spark, [resolve(spark, p) for p in inputs])
    if size is None or size < spec.staged_bytes:
        yield lambda df: df
        return
    with scratch_folder(spark, label) as folder:
        yield lambda df: staged(df, folder)


def build_weekly_stars(
    spark: SparkSession, layout: Layout, business: DataFrame | None = None, stage: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    return gold.weekly_stars(
        read_table(spark, layout.silver("review")), read_table(spark, layout.silver("business")) if business is None else business,
        count_column=_count_column("review", "review_id"), stage=stage,
    )


def build_checkins_vs_stars(spark: SparkSession, layout: Layout, business: DataFrame | None = None) -> DataFrame:
    return gold.checkins_vs_stars(
        read_table(spark, layout.silver("checkin")), read_table(spark, layout.silver("business")) if business is None else business,
        count_column=_count_column("checkin", "checkin_timestamp"),
    )


@contextmanager
def persisted(df: DataFrame, stored_bytes: int | None, most: float = 0.2) -> Iterator[DataFrame]:
    """``df`` kept by the executors inside the ``with`` block, if it is small; as it is otherwise.

    ``stored_bytes`` is its size as Parquet. Rows in memory take several times
    that (:data:`UNPACKED`), and may take the share ``most`` of what the executors
    have for storage. What does not fit after all goes to their disks. A lost executor's part is read
    again.
    """
    room = _storage_bytes(df.sparkSession)
    if stored_bytes is None or room is None or UNPACKED * stored_bytes > most * room:
        yield df
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


UNPACKED = 6  # bytes of a cached row per byte of Parquet; 2 to 5 on these tables


def _storage_bytes(spark: SparkSession) -> int | None:
    """Memory that all executors together have for cached data; None where that cannot be had (Spark Connect)."""
    try:
        values = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
        total = 0
        while values.hasNext():
            total += values.next()._1()
        return total
    except Exception:  # noqa: BLE001
        return None


def run_gold(spark: SparkSession, layout: Layout, spec: RunSpec = RunSpec()) -> dict[str, int]:
    tables = [g for g in GOLD_TABLES if set(GOLD_INPUTS[g]) <= set(spec.datasets)]
    for g in sorted(set(GOLD_TABLES) - set(tables)):
        log.warning("gold %s: skipped, its inputs %s are not all among the run's datasets", g, ", ".join(GOLD_INPUTS[g]))
    inputs = sorted({d for g in tables for d in GOLD_INPUTS[g]})
    s = freeing_session(_sized(spark, spec, "gold", [layout.silver(d) for d in inputs]))

    business: DataFrame | None = None

    def one(name: str) -> int:
        if name == "weekly_stars":
            by = spec.weekly_partition_by
            cluster = [c for c in spec.weekly_cluster_by if c not in by]
            with staging(s, spec, "weekly", [layout.silver("review")]) as stage:
                out = build_weekly_stars(s, layout, business, stage)
                rows = put_table(
                    s, spec, layout.gold(name),
                    lambda path: write_partitioned(out, path, by, cluster, bloom_filter_columns=spec.weekly_bloom_filters),
                )
        else:
            out = build_checkins_vs_stars(s, layout, business)
            rows = put_table(s, spec, layout.gold(name), lambda path: write_table(out, path))
        log.info("gold %s: %d rows", name, rows)
        return rows

    if not (spec.cache_business and len(tables) > 1):
        return _each(spark, _labelled(spark, "gold", one), tables, spec.concurrent)
    source = resolve(s, layout.silver("business"))
    with persisted(s.read.parquet(source).select(*BUSINESS_COLUMNS), input_bytes(s, [source])) as business:
        return _each(spark, _labelled(spark, "gold", one), tables, spec.concurrent)


LAYERS = ("bronze", "silver", "gold")


def run_layers(
    spark: SparkSession, layout: Layout, spec: RunSpec = RunSpec(), layers: tuple[str, ...] = LAYERS
) -> dict[str, dict[str, int]]:
    """Run the given layers in order; returns row counts per layer and table.

    Each layer reads only the tables the previous one wrote and overwrites
    its own with a deterministic result, so after a failure the run resumes
    from the failed layer (``layers=("silver", "gold")``) with the same
    output a full run would give.
    """
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    steps = {"bronze": run_bronze, "silver": run_silver, "gold": run_gold}
    return {name: steps[name](spark, layout, spec) for name in LAYERS if name in layers}


#: Parquet through the V2 source, which answers a count from file footers.
FOOTER_COUNTS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def layer_counts(spark: SparkSession, layout: Layout, datasets: tuple[str, ...] = DATASETS) -> DataFrame:
    """(layer, dataset, row_count) over every table that a run of ``datasets`` writes, as one Spark query.

    Counts come from the files' footers: no column of any table is read.
    """
    spark = layer_session(spark, FOOTER_COUNTS)
    tables = (
        [("bronze", d, layout.bronze(d)) for d in datasets]
        + [("silver", d, layout.silver(d)) for d in datasets]
        + [("gold", g, layout.gold(g)) for g in GOLD_TABLES if set(GOLD_INPUTS[g]) <= set(datasets)]
    )
    parts = [
        read_table(spark, path)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(layer).alias("layer"), F.lit(name).alias("dataset"), "row_count")
        for layer, name, path in tables
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
