import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from pitwall.session import get_spark
    s = get_spark("pitwall-tests", master="local[*]", shuffle_partitions=8)
    yield s
