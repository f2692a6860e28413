import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.session import checkpoint_root, get_session
    s = get_session("local[8]", app_name="strata-tests", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    checkpoint_root(s)
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"


def rows(df, *cols):
    """Collected rows as tuples, sorted, for order-insensitive asserts."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
