from __future__ import annotations

import pytest

from fleetlens.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(8, shuffle_partitions=4, memory="4g", name="tests", spark__sql__warehouse__dir=warehouse)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
