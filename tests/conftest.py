import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from metroscope.session import local_session, shared_root  # noqa: E402

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="metroscope-tests")
    shared_root(s)  # tests run without a cluster checkpoint folder: register a private one
    yield s
    s.stop()
