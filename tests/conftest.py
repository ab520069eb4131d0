import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dimwright.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("dimwright-tests", master="local[4]", shuffle_partitions=8)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dw-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted plain tuples of the selected columns."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, x) for x in t))
