import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from transit_prices.session import build_session, ensure_checkpoint_dir

    s = build_session(master="local[4]", shuffle_partitions=8)
    # tests only: a checkpoint folder when the session names none
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="tp-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tp-test-")
