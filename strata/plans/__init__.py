"""Session settings and the bronze -> silver -> gold run."""

from strata.plans.layers import Layout, RunSpec, layer_counts, run_bronze, run_gold, run_layers, run_silver
from strata.plans.session import (
    apply_conf,
    checkpoint_root,
    input_bytes,
    scratch_path,
    session_conf,
    shuffle_partitions_for,
)

__all__ = [
    "Layout",
    "RunSpec",
    "apply_conf",
    "checkpoint_root",
    "input_bytes",
    "layer_counts",
    "run_bronze",
    "run_gold",
    "run_layers",
    "run_silver",
    "scratch_path",
    "session_conf",
    "shuffle_partitions_for",
]
