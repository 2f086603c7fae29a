import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import get_spark
    s = get_spark("local[4]", 4)
    yield s


def rows(df, *cols):
    """Collected rows as tuples (optionally a column subset), in DataFrame order."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
