import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from martforge.session import checkpoint_dir, local_session

    s = local_session(cores=8, shuffle_partitions=8, app="martforge-tests")
    checkpoint_dir(s)  # local fallback: a fresh temporary folder
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
