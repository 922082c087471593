"""Raw JSON input, bronze ingest, Parquet sinks and driver-table adapters."""

from strata.sources import bronze, fixtures, raw, sinks

__all__ = ["bronze", "fixtures", "raw", "sinks"]
