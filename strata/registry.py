"""Every implemented operator as a query over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Inputs are the
raw-shaped adapters over the given tables (:mod:`strata.sources.fixtures`), so
every query's work grows with the tables. Queries that exercise a sink write
to a fresh folder under the session's shared checkpoint root and return what
they read back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import scalars as S
from strata.operators import analyses as A
from strata.operators import gold, state
from strata.operators.rules import explode_list as _explode
from strata.operators.silver import CHECKIN, SPECS
from strata.operators.rules import clean
from strata.operators.two_pass import clean_two_pass
from strata.plans.incremental import Ledger, apply_checkins, apply_reviews
from strata.plans.layers import Layout, RunSpec, layer_counts, run_layers
from strata.plans.session import freeing_session, remove, scratch_path
from strata.sources import bronze
from strata.sources.fixtures import ADAPTERS, raw
from strata.sources.layouts import read_bucketed, read_ordered, write_bucketed, write_ordered
from strata.sources.raw import DATASETS, RAW_SCHEMAS, read_declared, read_raw, write_raw
from strata.sources.sinks import write_partitioned, write_table
from strata.sources.versions import publish, read_table

# Analysis arguments that hit the driver data (its dates span 1995-2001).
PARAMS = {
    "year": 1998,
    "trend_year": 1998,
    "week": 47,
    "years": (1998, 1999),
    "business_name": "red widget",
    "scatter_below": 100,
    "scatter_n": 1000,
    "top_n": 10,
    "checkins_n": 20,
    "more_than": 1,
}

Query = Callable[[SparkSession, str], DataFrame]


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return clean(raw(spark, sf_dir, name), SPECS[name])


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.weekly_stars(silver(spark, sf_dir, "review"), silver(spark, sf_dir, "business"))


def cvs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.checkins_vs_stars(silver(spark, sf_dir, "checkin"), silver(spark, sf_dir, "business"))


def weekly_out(df: DataFrame) -> DataFrame:
    """weekly_stars columns in order, review_week as a date (the 9999 sentinel fits)."""
    return df.select(*[F.to_date(c).alias(c) if c == "review_week" else F.col(c) for c in gold.WEEKLY_STARS_COLUMNS])


def write_raw_files(spark: SparkSession, sf_dir: str, raw_dir: str, names=DATASETS, compression: str | None = None) -> Layout:
    """Materialise the adapters as newline-delimited JSON dumps (test input)."""
    layout, s = Layout(root=raw_dir.rsplit("/", 1)[0], raw=raw_dir), freeing_session(spark)
    for name in names:
        write_raw(raw(s, sf_dir, name), layout.raw_file(name), compression)
    return layout


#: The queries' dumps: as plain text they take about seven times the bytes of the tables that they are made from.
DUMPS = "gzip"


# ------------------------------------------------------------------ bronze, sinks
def json_scan(spark, sf_dir):
    root = scratch_path(spark, "json-scan")
    layout = write_raw_files(spark, sf_dir, f"{root}/raw", ("review",))
    return read_raw(spark, layout.raw_file("review"))


def bronze_metadata(spark, sf_dir):
    df = bronze.with_ingest_metadata(raw(spark, sf_dir, "business"), "business.json")
    return df.withColumn("ingested", F.col("ingestion_timestamp").isNotNull()).drop("ingestion_timestamp")


def bronze_load(spark, sf_dir):
    root = scratch_path(spark, "bronze-load")
    layout = write_raw_files(spark, sf_dir, f"{root}/raw", ("business",))
    bronze.load_to_bronze(spark, layout.raw_file("business"), layout.bronze("business"))
    return spark.read.parquet(layout.bronze("business")).drop("ingestion_timestamp", "source_file")


def bronze_counts(spark, sf_dir):
    root = scratch_path(spark, "bronze-counts")
    layout = write_raw_files(spark, sf_dir, f"{root}/raw")
    bronze.load_all(spark, layout.raw, f"{root}/bronze")
    return bronze.bronze_counts(spark, f"{root}/bronze")


def bronze_incremental(spark, sf_dir):
    """Raw business records arrive as two dumps; the second stream run ingests only the new one."""
    from strata.sources.fixtures import raw_business_arrivals
    from strata.streaming import ingest_available

    root = scratch_path(spark, "bronze-stream")
    bronze_path, ckpt = f"{root}/bronze/business", f"{root}/_checkpoint/business"
    for i, arrival in enumerate(raw_business_arrivals(spark, sf_dir)):
        write_raw(arrival, f"{root}/raw/arrival-{i}")
        ingest_available(spark, f"{root}/raw/*/part-*", bronze_path, ckpt, "business")
    return _typed_as(raw(spark, sf_dir, "business"), spark.read.parquet(bronze_path))


def _typed_as(like, df):
    """The columns of ``like``, cast from the declared schema's text to their types."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields))


def bronze_declared(spark, sf_dir):
    """The bronze load by the declared schema: the same values as the inferred one, as text."""
    root = scratch_path(spark, "bronze-declared")
    layout = write_raw_files(spark, sf_dir, f"{root}/raw", ("business",))
    bronze.load_to_bronze(spark, layout.raw_file("business"), layout.bronze("business"), RAW_SCHEMAS["business"])
    return _typed_as(raw(spark, sf_dir, "business"), spark.read.parquet(layout.bronze("business")))


DRIFT_SCHEMAS = {  # declared schemas that lack some keys of the dumps
    "business": "business_id string, name string, stars string, _corrupt_record string",
    "review": "review_id string, user_id string, business_id string, date string, _corrupt_record string",
}


def bronze_drift(spark, sf_dir):
    """What a load by a declared schema counts: keys it does not list, and lines cut off in the middle."""
    root = scratch_path(spark, "bronze-drift")
    parts = []
    for name, schema in DRIFT_SCHEMAS.items():
        rows = raw(spark, sf_dir, name)
        line = F.to_json(F.struct(*rows.columns))
        cut = F.substring(line, F.lit(1), F.length(line) - 1)
        rows.select(F.when(F.col("business_id").endswith("7"), cut).otherwise(line).alias("value")).write.text(f"{root}/raw/{name}")
        bronze.load(spark, f"{root}/raw/{name}", f"{root}/bronze/{name}", schema)
        report = bronze.drift_report(spark.read.parquet(f"{root}/bronze/{name}"))
        parts.append(report.select(F.lit(name).alias("dataset"), "problem", "key", F.col("rows")))
    return parts[0].unionByName(parts[1])


def versioned_publish(spark, sf_dir):
    """A table published twice, and a third write that fails half way: the second version is read."""
    path = scratch_path(spark, "versioned")
    business = silver(spark, sf_dir, "business")
    publish(spark, path, lambda folder: write_table(business.where("stars < 2"), folder))
    publish(spark, path, lambda folder: write_table(business, folder))
    broken = business.withColumn("stars", F.when(F.col("stars") > 4, F.raise_error(F.lit("a lost write"))).otherwise(0.0))
    try:
        publish(spark, path, lambda folder: write_table(broken, folder))
    except Exception as e:  # noqa: BLE001 - the failure is the point; anything else is one
        if "a lost write" not in str(e):
            raise
    return read_table(spark, path)


def silver_review_two_pass(spark, sf_dir):
    """Reviews deduplicated by moving only rows whose id repeats."""
    root = scratch_path(spark, "two-pass")
    write_table(raw(spark, sf_dir, "review"), f"{root}/bronze")
    return clean_two_pass(spark.read.parquet(f"{root}/bronze"), SPECS["review"], f"{root}/repeated")


def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "roundtrip")
    write_table(silver(spark, sf_dir, "business"), path)
    return spark.read.parquet(path)


def _run(spark, layout: Layout, spec: RunSpec = RunSpec()) -> Layout:
    """All layers; the query's own dumps go when they are loaded, for no later layer reads them."""
    run_layers(spark, layout, spec, ("bronze",))
    remove(spark, layout.raw)
    run_layers(spark, layout, spec, ("silver", "gold"))
    return layout


def _full_run(spark, sf_dir, spec: RunSpec = RunSpec()) -> Layout:
    root = scratch_path(spark, "layers")
    return _run(spark, write_raw_files(spark, sf_dir, f"{root}/raw", compression=DUMPS), spec)


def layer_counts_query(spark, sf_dir):
    return layer_counts(spark, _full_run(spark, sf_dir))


def end_to_end(spark, sf_dir):
    layout = _full_run(spark, sf_dir)
    return spark.read.parquet(layout.gold("checkins_vs_stars"))


def end_to_end_weekly(spark, sf_dir):
    """weekly_stars as the run writes it: its default layout, read back."""
    layout = _full_run(spark, sf_dir)
    return weekly_out(spark.read.parquet(layout.gold("weekly_stars")))


def _arrivals(spark, sf_dir, name: str, root: str, first, second) -> tuple[Layout, Iterator[tuple[str, DataFrame]]]:
    """Raw rows in three arrivals: ``first`` and ``second`` pick those of the first two. A run over the first one only.

    With it come the other two by name, each written when it is asked for and removed when the next one is.
    """
    layout = write_raw_files(spark, sf_dir, f"{root}/raw", tuple(d for d in DATASETS if d != name), DUMPS)
    rows = raw(freeing_session(spark), sf_dir, name)
    earlier, now = F.coalesce(first, F.lit(False)), F.coalesce(second, F.lit(False))
    write_raw(rows.where(earlier), layout.raw_file(name), DUMPS)

    def later() -> Iterator[tuple[str, DataFrame]]:
        for batch, some in (("second", ~earlier & now), ("third", ~earlier & ~now)):
            path = f"{root}/arrivals/{batch}"
            write_raw(rows.where(some), path, DUMPS)
            yield batch, read_declared(spark, path, RAW_SCHEMAS[name])
            remove(spark, path)

    return _run(spark, layout), later()


def weekly_incremental(spark, sf_dir):
    """weekly_stars after three arrivals of reviews, of which the last two touch some years only.

    Every id has its copies, with other payloads, in any of the arrivals.
    """
    root = scratch_path(spark, "weekly-incremental")
    year, part = F.col("date").substr(1, 4), F.pmod(F.xxhash64("user_id", "useful"), F.lit(4))
    late = year.isin("1996", "1997") & (part == 0)
    layout, later = _arrivals(spark, sf_dir, "review", root, ~late & ~((part == 1) & (year == "1998")) & ~year.startswith("b"), late)
    for batch, rows in later:
        apply_reviews(spark, layout, batch, rows)
        apply_reviews(spark, layout, batch, rows)  # a repeated batch changes nothing
    return weekly_out(read_table(spark, layout.gold("weekly_stars")))


def weekly_from_sums(spark, sf_dir):
    """weekly_stars from sums of three batches, compacted in between, and no review read for the last step."""
    root = scratch_path(spark, "weekly-sums")
    reviews = silver(spark, sf_dir, "review")
    ledger = Ledger(spark, f"{root}/sums", state.WEEKLY_KEYS)
    part = F.pmod(F.xxhash64("review_id"), F.lit(3))
    for k in range(3):
        ledger.commit(f"batch {k}", gold.weekly_sums(reviews.where(part == k)))
        if k == 1:
            ledger.compact()
    return weekly_out(state.weekly_stars(ledger.read(), silver(spark, sf_dir, "business")))


def weekly_bucketed(spark, sf_dir):
    """weekly_stars from sums and businesses that lie in the same buckets: no exchange below the join."""
    root = scratch_path(spark, "weekly-bucketed")
    write_bucketed(gold.weekly_sums(silver(spark, sf_dir, "review")), f"{root}/sums", "business_id", 8)
    write_bucketed(silver(spark, sf_dir, "business"), f"{root}/business", "business_id", 8)
    return weekly_out(state.weekly_stars(read_bucketed(spark, f"{root}/sums"), read_bucketed(spark, f"{root}/business")))


def weekly_ordered(spark, sf_dir):
    """weekly_stars written in its total order and read in it, without a sort."""
    path = scratch_path(spark, "weekly-ordered")
    write_ordered(weekly(spark, sf_dir), path, gold.WEEK_KEYS, 8)
    return weekly_out(read_ordered(spark, path))


def end_to_end_cached(spark, sf_dir):
    """checkins_vs_stars of a run that keeps silver.business in memory for both gold tables."""
    layout = _full_run(spark, sf_dir, RunSpec(cache_business=True))
    return spark.read.parquet(layout.gold("checkins_vs_stars"))


def checkins_incremental(spark, sf_dir):
    """checkins_vs_stars after three arrivals of check-in lists, some of which repeat check-ins of earlier ones."""
    root = scratch_path(spark, "checkins-incremental")
    part = F.pmod(F.xxhash64("date"), F.lit(3))
    layout, later = _arrivals(spark, sf_dir, "checkin", root, part == 0, part == 1)
    for batch, rows in later:
        apply_checkins(spark, layout, batch, rows)
    return read_table(spark, layout.gold("checkins_vs_stars"))


def weekly_partitioned(spark, sf_dir):
    path = scratch_path(spark, "weekly")
    write_partitioned(weekly(spark, sf_dir), path, ("review_week",), ("business_id",))
    return weekly_out(spark.read.parquet(path))


# ------------------------------------------------------------------ scalars, filters
def filter_star_range(spark, sf_dir):
    b = raw(spark, sf_dir, "business")
    return b.select("business_id", "stars").filter(F.col("stars").between(0, 5))


def scalar_trim(spark, sf_dir):
    b = raw(spark, sf_dir, "business")
    return b.select(
        F.col("business_id").alias("raw_business_id"),
        S.ascii_trim("business_id").alias("business_id"),
        F.col("name").alias("raw_name"),
        S.ascii_trim("name").alias("business_name"),
    )


def scalar_cast(spark, sf_dir):
    t = raw(spark, sf_dir, "tip")
    return t.select(
        "user_id",
        F.col("compliment_count").alias("raw_compliment_count"),
        S.tolerant_cast("compliment_count", "int", t.schema["compliment_count"].dataType).alias("compliment_count"),
    )


def scalar_parse_ts(spark, sf_dir):
    r = raw(spark, sf_dir, "review")
    return r.select(
        "review_id",
        F.col("date").alias("raw_date"),
        S.parse_timestamp("date").alias("review_ts"),
        S.parse_date("date").alias("review_date"),
    )


def explode_list(spark, sf_dir):
    return _explode(raw(spark, sf_dir, "checkin"), CHECKIN.explode, ["business_id"])


def week_parts(spark, sf_dir):
    d = F.col("review_date")
    return silver(spark, sf_dir, "review").select(
        "review_id",
        "review_date",
        F.to_date(S.week_start(d)).alias("review_week"),
        S.calendar_year(d).alias("review_year"),
        S.iso_week(d).alias("review_week_number"),
    )


def star_category(spark, sf_dir):
    b = silver(spark, sf_dir, "business")
    return b.select("business_id", "stars", S.star_category("stars").alias("star_category"))


# ------------------------------------------------------------------ gold
def weekly_agg(spark, sf_dir):
    w = gold.weekly_agg(silver(spark, sf_dir, "review"))
    return w.withColumn("review_week", F.to_date("review_week"))


def weekly_stars(spark, sf_dir):
    return weekly_out(gold.sort_weekly(weekly(spark, sf_dir)))


def checkins_vs_stars(spark, sf_dir):
    return gold.sort_checkins(cvs(spark, sf_dir))


def checkin_counts(spark, sf_dir):
    return A.checkin_counts(silver(spark, sf_dir, "checkin"))


# ------------------------------------------------------------------ analyses
def top_businesses_by_year(spark, sf_dir):
    return A.top_businesses_by_year(weekly(spark, sf_dir), PARAMS["year"], PARAMS["top_n"])


def weekly_multi_review(spark, sf_dir):
    return weekly_out(A.weekly_multi_review(weekly(spark, sf_dir), PARAMS["more_than"]))


def quality_summary(spark, sf_dir):
    return A.quality_summary(weekly(spark, sf_dir), cvs(spark, sf_dir))


def weekly_trend(spark, sf_dir):
    t = A.weekly_trend(weekly(spark, sf_dir), PARAMS["trend_year"])
    return t.withColumn("review_week", F.to_date("review_week"))


def checkin_scatter(spark, sf_dir):
    return A.checkin_scatter(cvs(spark, sf_dir), PARAMS["scatter_below"], PARAMS["scatter_n"])


def top_checkins(spark, sf_dir):
    return A.top_checkins(cvs(spark, sf_dir), PARAMS["checkins_n"])


def business_history(spark, sf_dir):
    return weekly_out(A.business_history(weekly(spark, sf_dir), PARAMS["business_name"]))


def same_week_yoy(spark, sf_dir):
    return weekly_out(A.same_week_yoy(weekly(spark, sf_dir), PARAMS["week"], PARAMS["years"]))


QUERIES: dict[str, Query] = {
    "json_scan": json_scan,
    "bronze_metadata": bronze_metadata,
    "bronze_load": bronze_load,
    "bronze_declared": bronze_declared,
    "bronze_counts": bronze_counts,
    "bronze_incremental": bronze_incremental,
    "bronze_drift": bronze_drift,
    "parquet_roundtrip": parquet_roundtrip,
    "versioned_publish": versioned_publish,
    "layer_counts": layer_counts_query,
    "silver_business": lambda spark, d: silver(spark, d, "business"),
    "silver_review": lambda spark, d: silver(spark, d, "review"),
    "silver_review_two_pass": silver_review_two_pass,
    "silver_checkin": lambda spark, d: silver(spark, d, "checkin"),
    "silver_user": lambda spark, d: silver(spark, d, "user"),
    "silver_tip": lambda spark, d: silver(spark, d, "tip"),
    "filter_star_range": filter_star_range,
    "scalar_trim": scalar_trim,
    "scalar_cast": scalar_cast,
    "scalar_parse_ts": scalar_parse_ts,
    "explode_list": explode_list,
    "week_parts": week_parts,
    "star_category": star_category,
    "weekly_agg": weekly_agg,
    "weekly_stars": weekly_stars,
    "weekly_partitioned": weekly_partitioned,
    "checkin_counts": checkin_counts,
    "checkins_vs_stars": checkins_vs_stars,
    "end_to_end": end_to_end,
    "end_to_end_weekly": end_to_end_weekly,
    "weekly_incremental": weekly_incremental,
    "weekly_from_sums": weekly_from_sums,
    "weekly_bucketed": weekly_bucketed,
    "weekly_ordered": weekly_ordered,
    "end_to_end_cached": end_to_end_cached,
    "checkins_incremental": checkins_incremental,
    "top_businesses_by_year": top_businesses_by_year,
    "weekly_multi_review": weekly_multi_review,
    "quality_summary": quality_summary,
    "weekly_trend": weekly_trend,
    "checkin_scatter": checkin_scatter,
    "top_checkins": top_checkins,
    "business_history": business_history,
    "same_week_yoy": same_week_yoy,
}

assert set(ADAPTERS) == set(DATASETS)
