import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    s = build_session(master="local[4]", app="tidemark-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-test-")})
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    # A fresh scratch folder per test; never reused, never cleared.
    return tempfile.mkdtemp(prefix="tidemark-test-")


def rows(df, *cols):
    """Collect as sorted list of tuples of the given columns."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
