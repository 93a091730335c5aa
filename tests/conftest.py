import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lamina.session import local_session

    s = local_session(cores="*", shuffle_partitions=8)
    yield s


def pytest_configure(config):
    config.addinivalue_line("markers", "slow: long model-training chain (LAMINA_SLOW=1 to run)")


def pytest_collection_modifyitems(config, items):
    if os.environ.get("LAMINA_SLOW") == "1":
        return
    skip = pytest.mark.skip(reason="set LAMINA_SLOW=1 to run the full training chain")
    for item in items:
        if "slow" in item.keywords:
            item.add_marker(skip)
