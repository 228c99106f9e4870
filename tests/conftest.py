from __future__ import annotations

import sys
import tempfile
import uuid
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pyspark.sql import SparkSession  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="landfall-tests-")
    s = (SparkSession.builder.master("local[*]")
         .appName("landfall-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.environment["PYTHONPATH"] = str(ROOT)  # for Python workers, whatever folder they start in
    # the configured shared checkpoint folder is used as it is; a private
    # temporary one only when none is configured
    from landfall.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def root(spark) -> str:
    """A fresh snapshot root for catalog tables written by one test."""
    from landfall.session import scratch_path
    return scratch_path(spark, "test-warehouse")


@pytest.fixture()
def tag() -> str:
    return uuid.uuid4().hex[:8]


def rows(df, *cols):
    """Sorted list of tuples (of the given columns, or all)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=repr)
