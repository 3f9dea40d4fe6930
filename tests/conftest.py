import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from sparrowmill.session import build_session  # noqa: E402
from sparrowmill.sources.tables import Tables  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="12g",
        spark__sql__maxMetadataStringLength="2000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def small():
    return str(DATA / "sf0.01")


@pytest.fixture(scope="session")
def tables(spark, small):
    return Tables(spark, small)
