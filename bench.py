"""Benchmark: the layered run plus every analysis, at $BENCH_SF_DIR on local[$BENCH_CPUS].

Setup (not timed): the driver tables are turned into the five raw JSON dumps.
Timed: bronze (JSON -> Parquet), silver (clean), gold (two tables), then each
analysis over the written gold tables, executed in full through the ``noop``
sink so no result rows travel to the driver. The headline ``value`` is this
first, cold-JVM pass. A second pass of the three layers (``warm_layers``)
shows the steady-state cost; ``BENCH_WARM=0`` skips it. Last, ``weekly_stars``
alone is timed on silver tables repeated ``BENCH_WEEKLY_COPIES`` times (19, about
5 million weekly rows at sf0.1; 0 skips it) under business ids of their own.
Prints one JSON line.
"""

from __future__ import annotations

import dataclasses
import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.operators import analyses as A  # noqa: E402
from strata.plans.layers import Layout, RunSpec, run_bronze, run_gold, run_silver  # noqa: E402
from strata.plans.session import scratch_path, session_conf  # noqa: E402
from strata.registry import PARAMS, write_raw_files  # noqa: E402


def session(cpus: int) -> SparkSession:
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strata-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus))
    for k, v in session_conf(shuffle_partitions=parts).items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-bench-"))
    return s


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def repeated(spark: SparkSession, layout: Layout, root: str, copies: int) -> Layout:
    """A layout whose silver reviews and businesses are ``layout``'s, ``copies`` times, each copy with its own business ids."""
    out = dataclasses.replace(layout, root=root)
    for name in ("review", "business"):
        df = spark.read.parquet(layout.silver(name))
        df = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        df = df.withColumn("business_id", F.concat_ws("-", "business_id", "copy")).drop("copy")
        df.write.parquet(out.silver(name))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cpus)

    root = scratch_path(spark, "bench")
    layout = write_raw_files(spark, sf_dir, f"{root}/raw")
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up

    spec = RunSpec(concurrent=os.environ.get("BENCH_CONCURRENT", "1") == "1")
    times: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    for layer, fn in (("bronze", run_bronze), ("silver", run_silver), ("gold", run_gold)):
        counts = timed(layer, lambda fn=fn: fn(spark, layout, spec))
        rows.update({f"{layer}.{k}": v for k, v in counts.items()})

    weekly = spark.read.parquet(layout.gold("weekly_stars"))
    cvs = spark.read.parquet(layout.gold("checkins_vs_stars"))
    checkins = spark.read.parquet(layout.silver("checkin"))
    p = PARAMS
    analyses = {
        "top_businesses_by_year": lambda: A.top_businesses_by_year(weekly, p["year"], p["top_n"]),
        "weekly_multi_review": lambda: A.weekly_multi_review(weekly, p["more_than"]),
        "quality_summary": lambda: A.quality_summary(weekly, cvs),
        "weekly_trend": lambda: A.weekly_trend(weekly, p["trend_year"]),
        "checkin_scatter": lambda: A.checkin_scatter(cvs, p["scatter_below"], p["scatter_n"]),
        "top_checkins": lambda: A.top_checkins(cvs, p["checkins_n"]),
        "business_history": lambda: A.business_history(weekly, p["business_name"]),
        "checkin_counts": lambda: A.checkin_counts(checkins),
        "same_week_yoy": lambda: A.same_week_yoy(weekly, p["week"], p["years"]),
    }
    for name, build in analyses.items():
        timed(name, lambda build=build: run(build()))
    total = round(sum(times.values()), 3)

    # Second pass of the three layers into a fresh layout, with the JVM warm
    # (JIT-compiled readers and writers, generated code cached): the
    # steady-state cost per layer, reported next to the cold first pass.
    warm: dict[str, float] = {}
    if os.environ.get("BENCH_WARM", "1") == "1":
        again = dataclasses.replace(layout, root=scratch_path(spark, "bench-warm"))
        for layer, fn in (("bronze", run_bronze), ("silver", run_silver), ("gold", run_gold)):
            t0 = time.perf_counter()
            fn(spark, again, spec)
            warm[layer] = round(time.perf_counter() - t0, 3)

    # Near the size of the published baseline, where fixed costs no longer count.
    copies = int(os.environ.get("BENCH_WEEKLY_COPIES", "19"))
    large: dict[str, float] = {}
    if copies > 0:
        big = repeated(spark, layout, scratch_path(spark, "bench-weekly"), copies)
        alone = dataclasses.replace(spec, datasets=("review", "business"))
        t0 = time.perf_counter()
        n = run_gold(spark, big, alone)["weekly_stars"]
        seconds = time.perf_counter() - t0
        large = {"copies": copies, "rows": n, "sec": round(seconds, 3), "rows_per_sec": round(n / seconds, 1)}

    weekly_rows = rows.get("gold.weekly_stars", 0)
    bronze_rows = sum(v for k, v in rows.items() if k.startswith("bronze."))
    print(
        json.dumps(
            {
                "metric": "layers_and_analyses_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
                "rows": rows,
                "weekly_stars_rows_per_sec": round(weekly_rows / times["gold"], 1) if times["gold"] else None,
                "bronze_rows_per_sec": round(bronze_rows / times["bronze"], 1),
                "weekly_stars_large": large or None,
                "warm_layers": warm,
                "warm_layers_total": round(sum(warm.values()), 3) if warm else None,
                "warm_weekly_stars_rows_per_sec": round(weekly_rows / warm["gold"], 1) if warm.get("gold") else None,
                "warm_bronze_rows_per_sec": round(bronze_rows / warm["bronze"], 1) if warm.get("bronze") else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
