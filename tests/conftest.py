import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from zpoints.session import get_spark
    s = get_spark(os.environ.get("ZPOINTS_TEST_CORES", "*"), shuffle_partitions=8, app="zpoints-tests")
    yield s
    s.stop()


def enc(x: int, y: int, z: int) -> int:
    """Reference Morton encoder, bit by bit (for tests only)."""
    c = 0
    for i in range(21):
        c |= ((x >> i) & 1) << (3 * i) | ((y >> i) & 1) << (3 * i + 1) | ((z >> i) & 1) << (3 * i + 2)
    return c


def dec(c: int):
    return tuple(sum(((c >> (3 * i + d)) & 1) << i for i in range(21)) for d in range(3))
