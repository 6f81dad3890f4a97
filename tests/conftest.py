import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cohortix.session import local_session

    s = local_session("local[4]")
    s.conf.set("spark.sql.shuffle.partitions", "8")
    yield s
