import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from farebox.session import ensure_checkpoint_dir, get_spark

    path = os.pathsep.join([ROOT, os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH", "")])
    os.environ["PYTHONPATH"] = path
    s = get_spark(master="local[4]", shuffle_partitions=4, extra={"spark.executorEnv.PYTHONPATH": path})
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="farebox-test-")


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
