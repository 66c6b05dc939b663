import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakestar.session import ensure_checkpoint_dir, get_spark  # noqa: E402

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="lakestar-tests", shuffle_partitions=4)
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
