import os
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillbook.operators.batch import Batch
from quillbook.session import configure

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(root / "shared"))
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture
def batch():
    return Batch("core", "general_ledger_header", date(2025, 12, 5), 7, datetime(2025, 12, 8, 8, 30, 15))


def values(df, *columns):
    """Rows as a sorted list of tuples."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((v is not None, str(v)) for v in t))
