import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"
# Tables the oracle comparison runs on; STRATA_ORACLE_SF=/root/testdata/sf0.01
# repeats the driver's larger check.
ORACLE_DIR = os.environ.get("STRATA_ORACLE_SF", SMALL)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("strata-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    yield s
    from strata.plans.session import clear_scratch

    clear_scratch(s)


@pytest.fixture(scope="module", autouse=True)
def nothing_cached_by_others():
    """Tables that one module's tests cached are gone before the next module's."""
    yield
    from pyspark.sql import SparkSession

    if (s := SparkSession.getActiveSession()) is not None:
        s.catalog.clearCache()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(ORACLE_DIR) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con
