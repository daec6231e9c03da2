import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from creamery.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(master="local[*]", app_name="creamery-tests", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    """A fresh folder below the session's shared scratch root."""
    from creamery.session import scratch_dir

    return scratch_dir(spark, "test")
