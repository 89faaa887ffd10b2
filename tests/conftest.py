import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakeforge.session import build_session

    # Tests set their own checkpoint folder only because none is configured
    # for a local test session; on a cluster the session names it.
    ckpt = tempfile.mkdtemp(prefix="lakeforge-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="lakeforge-tests",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ckpt},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lakeforge-test-")


def rows(df, order=None):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr) if order is None else out
