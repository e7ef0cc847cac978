import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
sys.path.insert(0, ROOT)
# Python workers unpickle test-module functions by reference: give them the paths.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, HERE] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])


@pytest.fixture(scope="session")
def spark():
    from gradeflow.session import checkpoint_root, local_session

    s = local_session(4, app="gradeflow-tests", shuffle_partitions=4)
    checkpoint_root(s)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
