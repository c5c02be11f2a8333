import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from gablework.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "gablework-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


LISTING_DDL = (
    "listing_id string, area double, bedrooms int, bathrooms int, age_years double, "
    "has_garage int, district string, price double"
)


@pytest.fixture(scope="session")
def tiny(spark):
    rows = [
        ("a", 100.0, 2, 1, 5.0, 1, "Centre", 300000.0),
        ("b", 150.0, 3, 2, 10.0, 1, "South", 500000.0),
        ("c", 80.0, 1, 1, 2.0, 0, "Centre", 200000.0),
        ("d", 200.0, 4, 3, 15.0, 1, "North", 700000.0),
        ("e", 120.0, 2, 2, 8.0, 1, "Centre", 350000.0),
    ]
    return spark.createDataFrame(rows, LISTING_DDL)
