import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lumenrec.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    # tests own their checkpoint folder; a cluster names a shared one instead
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lumenrec-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the selected columns."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
