import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from quadspark.session import build_session

    session = build_session(8, "quadspark-tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        "spark.sql.streaming.metricsEnabled": "false"})
    yield session
    session.stop()


@pytest.fixture
def place(tmp_path):
    """A fresh folder as a string."""
    return str(tmp_path)
