import os

import pytest

from cliplake.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", cores="4", **{"spark.sql.shuffle.partitions": "6", "spark.driver.memory": "4g"})
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session


@pytest.fixture(scope="session")
def data():
    folder = os.environ.get("CLIPLAKE_DATA", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("the test tables are not here")
    return folder
