import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tidemark.session import checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tidemark-test-")
    s = local_session(cores=4, shuffle_partitions=4, app="tidemark-tests",
                      warehouse_dir=os.path.join(scratch, "warehouse"))
    checkpoint_dir(s)
    yield s
    s.stop()
