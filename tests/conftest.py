import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldlens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    s = build_session(master="local[*]", shuffle_partitions=8, extra={"spark.checkpoint.dir": shared})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def root():
    return SF_SMALL
