import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gpsweave.session import build_session, checkpoint_dir
    s = build_session("local[8]", app="gpsweave-tests", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck01():
    from oracle_harness import duck
    return duck(SF01)


@pytest.fixture(scope="session")
def duck001():
    from oracle_harness import duck
    return duck(SF001)
