import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "America/Los_Angeles").config("spark.driver.memory", "4g").config("spark.checkpoint.dir", tempfile.mkdtemp()).config("spark.sql.warehouse.dir", tempfile.mkdtemp())
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    c = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        c.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}{'/*.parquet' if f.is_dir() else ''}'")
    return c
