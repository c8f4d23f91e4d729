from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from rookery import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    session = build_session("tests", "local[8]", settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression."""
    return lambda column: spark.range(1).select(column.alias("v")).first()["v"]


@pytest.fixture
def database(spark, request):
    """A database of its own for each test."""
    import uuid

    from rookery import scratch_path
    from rookery.plans.load import GameTables

    name = f"t_{uuid.uuid4().hex}"
    return GameTables.create(spark, name, scratch_path(spark, name))
