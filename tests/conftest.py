import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from hausprep.session import build_session, checkpoint_dir

    s = build_session("local[4]", app_name="hausprep-tests", shuffle_partitions=8)
    checkpoint_dir(s)  # read from the session; set only when unset
    yield s
    s.stop()
