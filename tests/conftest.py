import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vintagelake.session import ensure_checkpoint_dir, get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="vintagelake-tests", shuffle_partitions=8)
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples, for order-insensitive comparison."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
