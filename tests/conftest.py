import csv
import io
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierflow.session import build_session  # noqa: E402
from tierflow.sources import TableStore  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tierflow-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tierflow-test-")


@pytest.fixture
def store(spark, folder):
    return TableStore(spark, f"{folder}/tables")


@pytest.fixture
def land(folder):
    """Write rows (dicts or lists) as a CSV file the way an extractor does."""

    def write(source, name, header, rows):
        path = os.path.join(folder, "landing", source)
        os.makedirs(path, exist_ok=True)
        buffer = io.StringIO()
        writer = csv.writer(buffer)
        writer.writerow(header)
        for row in rows:
            cells = [row.get(h, "") for h in header] if isinstance(row, dict) else row
            writer.writerow(["" if c is None else c for c in cells])
        with open(os.path.join(path, name), "w", newline="") as f:
            f.write(buffer.getvalue())
        return path

    return write
