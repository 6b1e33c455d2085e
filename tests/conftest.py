import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventlens.session import build_session  # noqa: E402
from eventlens.streaming import jobs  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    jobs.PARTS = 3          # registered streams: three triggers are enough to carry state and close windows
    s = build_session("local[4]", app="eventlens-tests", shuffle_partitions=8)
    yield s
    s.stop()
