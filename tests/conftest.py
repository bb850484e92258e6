import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app="ledgerline-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def raw(spark):
    from ledgerline.sources.fixtures import transactions_n
    return transactions_n(spark, SF_SMALL)
