import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import local_session

    s = local_session(4, shuffle_partitions=4, app_name="strata-tests", driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_smoke():
    if not os.path.exists(SF_SMOKE):
        pytest.skip("test data not available")
    return SF_SMOKE


def rows(df, *cols):
    """Collected rows as plain tuples, sorted (NULLs first)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((v is not None, v) for v in t))
