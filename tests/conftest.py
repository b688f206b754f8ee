import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from crashgrid.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8)
    # Tests run without a cluster-provided folder: only here is one chosen.
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="crashgrid-test-ckpt-"))
    yield s
    s.stop()


def have_data(path: str) -> bool:
    return os.path.exists(os.path.join(path, "events.parquet"))
