import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from stratamart.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests")
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    path = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
    if not path.exists():
        pytest.skip(f"no test tables at {path}")
    return str(path)


@pytest.fixture
def warehouse(spark, tmp_path):
    from stratamart.sources.tables import Warehouse

    return Warehouse(spark, str(tmp_path / "warehouse"))
