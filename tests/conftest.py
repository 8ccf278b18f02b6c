from __future__ import annotations

import sys
from itertools import count
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from crease.session import builder  # noqa: E402
from crease.sources.tables import Warehouse  # noqa: E402

_numbers = count()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("crease-tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    """Opens a warehouse in a folder of the test; the same name opens the same folder."""

    def open_(name: str = "wh") -> Warehouse:
        return Warehouse(spark, str(tmp_path / name), f"test_{next(_numbers)}")

    return open_
