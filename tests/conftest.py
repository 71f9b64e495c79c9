import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="starloom-tests", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (order-free comparison)."""
    cols = cols or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
