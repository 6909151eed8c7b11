import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from sensorweave.session import build_session  # noqa: E402
from sensorweave.sources.config import default_config  # noqa: E402

RAW_COLUMNS = "sensor_id string, timestamp string, reading_type string, value double, battery_level double"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("staging")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def config(spark):
    return default_config(spark)


@pytest.fixture
def readings(spark):
    """Rows of one or more files: tuples of the raw columns, numbered in the given order."""

    def make(rows, file_name="a.parquet"):
        numbered = [(i, file_name, *row) for i, row in enumerate(rows)]
        return spark.createDataFrame(numbered, f"row_index long, file_name string, {RAW_COLUMNS}")

    return make
