"""Command-line run of the three layers (``python -m strata`` or spark-submit).

Takes the folder layout, Spark settings and dataset list either as flags or
from a YAML/JSON file shaped like::

    paths:    {raw: ..., bronze: ..., silver: ..., gold: ...}
    spark:    {app_name: ..., shuffle_partitions: ..., driver_memory: ..., executor_memory: ...}
    datasets: [business, review, user, checkin, tip]

The master comes from spark-submit (or Spark's local default), never from
here. Row counts per layer and table are logged and printed as one JSON line.
A failure is logged and re-raised, so the process exits non-zero.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from strata.plans.layers import LAYERS, Layout, RunSpec, run_layers
from strata.plans.session import INITIAL_PARTITIONS, SPLIT_BYTES, session_conf
from strata.sources.bronze import Limits
from strata.sources.raw import DATASETS, RAW_FILE

log = logging.getLogger("strata")

_MEMORY_KEYS = {"driver_memory": "spark.driver.memory", "executor_memory": "spark.executor.memory"}
_SHUFFLE_KEYS = ("spark.sql.shuffle.partitions", INITIAL_PARTITIONS)
_SPLIT_KEY = SPLIT_BYTES


@dataclass
class RunConfig:
    raw: str
    root: str | None = None
    bronze: str | None = None
    silver: str | None = None
    gold: str | None = None
    raw_pattern: str = RAW_FILE
    app_name: str | None = None
    shuffle_partitions: int | None = None
    spark_conf: dict[str, str] = field(default_factory=dict)
    datasets: tuple[str, ...] = DATASETS
    declared_schemas: bool = False
    weekly_partition_by: tuple[str, ...] = ("review_year",)
    concurrent: bool = True
    versioned: bool = False
    limits: Limits = Limits()
    layers: tuple[str, ...] = LAYERS

    def layout(self) -> Layout:
        root = self.root
        if root is None:
            if not (self.bronze and self.silver and self.gold):
                raise ValueError("give --root, or all of --bronze, --silver and --gold")
            root = self.bronze.rstrip("/").rsplit("/", 1)[0]
        return Layout(
            root=root.rstrip("/"),
            raw=self.raw,
            raw_pattern=self.raw_pattern,
            bronze_root=self.bronze,
            silver_root=self.silver,
            gold_root=self.gold,
        )

    def explicit_conf(self) -> dict[str, str]:
        """Settings the user asked for: ``--conf``, config-file memory, ``--shuffle-partitions``."""
        out = dict(self.spark_conf)
        if self.shuffle_partitions is not None:
            out["spark.sql.shuffle.partitions"] = str(self.shuffle_partitions)
        return out

    def run_spec(self, configured: Callable[[str], bool] = lambda key: False) -> RunSpec:
        """The run's spec. ``configured(key)`` tells whether the user set a Spark setting
        (here or through spark-submit); sizing never overrides such a setting."""
        explicit = self.explicit_conf()

        def chosen(key: str) -> bool:
            return key in explicit or configured(key)

        return RunSpec(
            datasets=self.datasets,
            declared_schemas=self.declared_schemas,
            weekly_partition_by=self.weekly_partition_by,
            concurrent=self.concurrent,
            versioned=self.versioned,
            limits=self.limits,
            size_shuffles=not any(chosen(k) for k in _SHUFFLE_KEYS),
            raw_split_bytes=None if chosen(_SPLIT_KEY) else RunSpec.raw_split_bytes,
            silver_split_bytes=None if chosen(_SPLIT_KEY) else RunSpec.silver_split_bytes,
        )


def _load_file(path: str) -> dict:
    with open(path) as fh:
        text = fh.read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:  # pragma: no cover - depends on the environment
            raise RuntimeError("reading a YAML config needs PyYAML; give a JSON file instead") from e
        return yaml.safe_load(text) or {}
    return json.loads(text)


def _section(doc: dict, name: str) -> dict:
    value = doc.get(name) or {}
    if not isinstance(value, dict):
        raise ValueError(f"config section {name!r} must be a mapping")
    return value


def config_from_file(path: str) -> dict:
    """Flatten a config file into :class:`RunConfig` keyword arguments."""
    doc = _load_file(path)
    if not isinstance(doc, dict):
        raise ValueError("a config file holds a mapping with paths, spark and datasets sections")
    paths = _section(doc, "paths")
    spark = _section(doc, "spark")
    out: dict = {}
    for k in ("raw", "bronze", "silver", "gold", "root", "raw_pattern"):
        if paths.get(k) is not None:
            if not isinstance(paths[k], str) or not paths[k]:
                raise ValueError(f"paths.{k} must be a folder name (text)")
            out[k] = paths[k]
    if spark.get("app_name") is not None:
        out["app_name"] = str(spark["app_name"])
    n = spark.get("shuffle_partitions")
    if n is not None:
        if isinstance(n, bool) or not str(n).isdigit() or int(n) < 1:
            raise ValueError("spark.shuffle_partitions must be a positive whole number")
        out["shuffle_partitions"] = int(n)
    out["spark_conf"] = {}
    for k, key in _MEMORY_KEYS.items():
        v = spark.get(k)
        if v is not None:
            if not isinstance(v, str) or not v[-1:].isalpha():
                raise ValueError(f"spark.{k} needs a size with a unit, such as '8g'")
            out["spark_conf"][key] = v
    if doc.get("datasets") is not None:
        datasets = doc["datasets"]
        if not isinstance(datasets, list) or not datasets or not all(isinstance(d, str) for d in datasets):
            raise ValueError("datasets must be a non-empty list of names")
        out["datasets"] = tuple(datasets)
    return out


def parse_args(argv: Sequence[str] | None = None) -> RunConfig:
    p = argparse.ArgumentParser(prog="strata", description="raw JSON -> bronze -> silver -> gold Parquet")
    p.add_argument("--config", help="YAML or JSON file with paths, spark and datasets sections")
    p.add_argument("--raw", help="folder holding the raw JSON dumps")
    p.add_argument(
        "--raw-pattern", help=f"file name of each dump, with {{name}} for the dataset (default {RAW_FILE})"
    )
    p.add_argument("--root", help="output root; layers go to <root>/{bronze,silver,gold}")
    p.add_argument("--bronze", help="bronze folder (overrides <root>/bronze)")
    p.add_argument("--silver", help="silver folder (overrides <root>/silver)")
    p.add_argument("--gold", help="gold folder (overrides <root>/gold)")
    p.add_argument("--app-name")
    p.add_argument("--shuffle-partitions", type=int)
    p.add_argument("--datasets", help="comma-separated subset of " + ",".join(DATASETS))
    p.add_argument(
        "--declared-schemas", action="store_true",
        help="read the raw JSON with the declared schemas: no inference pass; keys outside of them are counted and kept in _rescued",
    )
    p.add_argument("--infer-schemas", action="store_true", help="infer raw JSON schemas (the default: keeps every key)")
    p.add_argument("--weekly-partition-by", help="comma-separated partition columns of weekly_stars")
    p.add_argument("--versioned", action="store_true", help="write tables as versions and switch to them when they are complete")
    p.add_argument("--max-corrupt", type=float, metavar="SHARE", help="fail a bronze load with a larger share of lines that are no records")
    p.add_argument("--max-drifted", type=float, metavar="SHARE", help="fail a declared load with a larger share of rows with undeclared keys")
    p.add_argument("--serial", action="store_true", help="run the tables of a layer one after another")
    p.add_argument(
        "--conf", action="append", default=[], metavar="KEY=VALUE",
        help="Spark setting, repeatable; wins over spark-submit and the defaults file",
    )
    p.add_argument(
        "--layers", help="comma-separated layers to run, e.g. silver,gold to resume after bronze (default: all)"
    )
    a = p.parse_args(argv)

    try:
        kw = config_from_file(a.config) if a.config else {}
    except Exception as e:  # noqa: BLE001 - unreadable, unparsable or mistyped: all argument errors
        p.error(f"cannot use config {a.config}: {e}")
    for name in ("raw", "raw_pattern", "root", "bronze", "silver", "gold", "app_name", "shuffle_partitions"):
        v = getattr(a, name)
        if v is not None:
            kw[name] = v
    if a.datasets:
        kw["datasets"] = tuple(d.strip() for d in a.datasets.split(",") if d.strip())
    if a.weekly_partition_by:
        kw["weekly_partition_by"] = tuple(c.strip() for c in a.weekly_partition_by.split(",") if c.strip())
    if a.layers:
        kw["layers"] = tuple(x.strip() for x in a.layers.split(",") if x.strip())
        if set(kw["layers"]) - set(LAYERS):
            p.error(f"unknown layers in {a.layers!r}; choose from {','.join(LAYERS)}")
    extra = {}
    for item in a.conf:
        if "=" not in item:
            p.error(f"--conf needs KEY=VALUE, got {item!r}")
        k, v = item.split("=", 1)
        extra[k.strip()] = v.strip()
    kw["spark_conf"] = {**kw.get("spark_conf", {}), **extra}
    kw["declared_schemas"] = a.declared_schemas and not a.infer_schemas
    kw["concurrent"] = not a.serial
    kw["versioned"] = a.versioned
    kw["limits"] = Limits(a.max_corrupt, a.max_drifted)
    if "raw" not in kw:
        p.error("the raw folder is required (--raw or paths.raw in --config)")
    if "{name}" not in kw.get("raw_pattern", RAW_FILE):
        p.error("--raw-pattern must contain {name}")
    if "root" not in kw and not all(kw.get(k) for k in ("bronze", "silver", "gold")):
        p.error("give --root, or all of --bronze, --silver and --gold (or paths.* in --config)")
    unknown = set(kw.get("datasets", ())) - set(DATASETS)
    if unknown:
        p.error(f"unknown datasets: {sorted(unknown)}")
    if len(set(kw.get("datasets", ()))) != len(kw.get("datasets", ())):
        p.error("each dataset may be named once")
    return RunConfig(**kw)


# Applied only where neither spark-submit, the defaults file nor --conf set a value.
DEFAULT_CONF = {**session_conf(), "spark.ui.enabled": "false"}
# Applied unless --conf names them: results depend on them. In any zone with
# daylight saving, two distinct check-in times in the spring gap parse to one
# instant and the check-in dedup would merge them.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC"}


def build_session(cfg: RunConfig):
    """The run's session and a test for "did spark-submit or the defaults file set this key".

    Precedence: --conf and other explicit flags, then :data:`REQUIRED_CONF`,
    then whatever spark-submit or the defaults file set, then
    :data:`DEFAULT_CONF`. When this process starts the JVM itself, the
    explicit settings are given at launch, so driver memory and other
    launch-time settings take effect.
    """
    from pyspark import SparkConf, SparkContext
    from pyspark.sql import SparkSession

    explicit = cfg.explicit_conf()
    launch = SparkConf(loadDefaults=False)
    for k, v in explicit.items():
        launch.set(k, v)
    SparkContext._ensure_initialized(conf=launch)  # under spark-submit: joins the running JVM
    preset = SparkConf()  # now includes spark-submit's and the defaults file's settings
    builder = SparkSession.builder
    launcher_name = preset.get("spark.app.name", None)
    if cfg.app_name or launcher_name in (None, "pyspark-shell") or launcher_name.endswith(".py"):
        builder = builder.appName(cfg.app_name or "strata")
    for k, v in DEFAULT_CONF.items():
        if k not in explicit and k not in REQUIRED_CONF and not preset.contains(k):
            builder = builder.config(k, v)
    for k, v in REQUIRED_CONF.items():
        if k not in explicit and preset.contains(k) and preset.get(k) != v:
            log.warning("%s=%s from spark-submit or the defaults file is replaced by %s "
                        "(give --conf %s=... to keep another)", k, preset.get(k), v, k)
    for k, v in {**REQUIRED_CONF, **explicit}.items():
        builder = builder.config(k, v)

    return builder.getOrCreate(), preset.contains


def main(argv: Sequence[str] | None = None) -> dict[str, dict[str, int]]:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    cfg = parse_args(argv)
    layout = cfg.layout()
    spark, preset = build_session(cfg)
    try:
        log.info("run: raw=%s bronze=%s silver=%s gold=%s", layout.raw, layout.bronze(""), layout.silver(""),
                 layout.gold(""))
        counts = run_layers(spark, layout, cfg.run_spec(preset), cfg.layers)
        for layer, per in counts.items():
            for name, n in per.items():
                log.info("%s %s: %d rows", layer, name, n)
        print(json.dumps(counts))
        return counts
    except Exception:
        log.exception("run failed")
        raise
    finally:
        spark.stop()


def console(argv: Sequence[str] | None = None) -> int:
    """Installed ``strata`` command: exit status 0 on success (errors raise)."""
    main(argv)
    return 0


if __name__ == "__main__":  # pragma: no cover
    main(sys.argv[1:])
