import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardwatch.session import build_session, shared_dir  # noqa: E402

SRC = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "cardwatch-tests",
        f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture
def scattered(spark):
    """Shuffles keep all their partitions, however small, so that work across ranges is exercised."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield spark
    spark.conf.set(name, "true")


@pytest.fixture(scope="session")
def src():
    return SRC
