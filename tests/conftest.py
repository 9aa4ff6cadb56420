import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tidyloom.settings import BORDERS_PER_PARTITION, build_session  # noqa: E402

TABLES = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tidyloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def split(spark):
    """Draw more borders than small tables have rows."""
    spark.conf.set(BORDERS_PER_PARTITION, "200")
    yield
    spark.conf.unset(BORDERS_PER_PARTITION)


def rows(frame, *columns):
    """Rows as sorted plain tuples."""
    found = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in found.collect()), key=lambda row: [(value is not None, str(value)) for value in row])
