import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).parent.parent
sys.path[:0] = [str(ROOT), str(Path(__file__).parent)]


def new_session() -> SparkSession:
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]").appName("starmart-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"{base}/shared")
        .config("spark.sql.warehouse.dir", f"{base}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = new_session()
    yield session
    session.stop()
