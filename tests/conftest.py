import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoalcast.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("written")), "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows():
    """Rows of a frame as plain tuples in a stable order."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
