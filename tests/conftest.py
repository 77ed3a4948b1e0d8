import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_TINY = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from linfold.session import local_session, shared_dir

    s = local_session("*", shuffle_partitions=8, driver_memory="6g")
    shared_dir(s)  # tests set their own checkpoint folder (the session has none)
    yield s
    s.stop()
