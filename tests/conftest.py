import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from statloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        shuffle_partitions=2,
        extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
