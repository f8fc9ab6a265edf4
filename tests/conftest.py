from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from jobtrend.session import build_session, ensure_checkpoint_dir

    s = build_session("local[*]", app_name="jobtrend-tests", shuffle_partitions=8)
    # tests only: a checkpoint folder of their own when the session names none
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
