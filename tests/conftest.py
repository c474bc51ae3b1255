import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weir.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8)
    # Tests only: the checkpoint folder is unset here, so take a scratch one.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="weir-test-ckpt-"))
    checkpoint_dir(s)
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="weir-test-")
