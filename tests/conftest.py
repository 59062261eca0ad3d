import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gridlens.session import get_session, shared_dir
    s = get_session("gridlens-tests", master="local[4]", shuffle_partitions=4)
    shared_dir(s)  # uses spark.checkpoint.dir, or a scratch folder when unset
    yield s
    s.stop()
