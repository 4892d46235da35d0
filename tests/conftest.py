import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reportlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "6g")
    s.sparkContext.setLogLevel("ERROR")
    return s


def rows(df, *keys):
    """Collected rows as tuples, sorted by the key columns."""
    return [tuple(r) for r in (df.orderBy(*keys) if keys else df).collect()]
