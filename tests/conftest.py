import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from eventlake.session import ensure_utc, use_scratch_folder

    s = (
        SparkSession.builder.master("local[*]")
        .appName("eventlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_utc(s)
    use_scratch_folder(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def registry():
    from eventlake.plans import load_all

    return load_all()


def rows(df, *cols):
    """Collect a small test result as sorted tuples."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
