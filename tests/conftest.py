from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesmarts.session import configure  # noqa: E402

os.environ.setdefault("PYTHONHASHSEED", "0")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        configure(SparkSession.builder.master("local[8]").appName("tests"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "shared"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """All rows as tuples, sorted, so that tests do not depend on row order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
