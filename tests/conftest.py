import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from broadsheet.session import build_session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
                            spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def data():
    return DATA
