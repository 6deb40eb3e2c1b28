import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tempolith.session import checkpoint_dir, get_spark
    s = get_spark(app="tempolith-tests", master="local[4]", shuffle_partitions=4)
    checkpoint_dir(s)
    yield s
