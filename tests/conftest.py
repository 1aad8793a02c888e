import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from weft.session import local_session

    s = local_session(cpus="*", shuffle_partitions=8, app="weft-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def knowledge_text():
    with open(os.path.join(FIXTURES, "knowledge.txt"), encoding="utf-8") as f:
        return f.read()


def rows(df, *cols):
    """Collected rows as plain tuples, ordered."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
