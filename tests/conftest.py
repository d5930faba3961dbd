import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetmart import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session.build(
        "tests", "local[8]", shuffle_partitions=4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")), spark__driver__memory="6g", spark__driver__host="127.0.0.1",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
