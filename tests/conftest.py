import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tallyfold.session import build_session

    s = build_session(master="local[4]", partitions=4, app="tallyfold-tests")
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def nothing_cached(request):
    """A module that uses Spark starts without the frames that another one cached: Spark would
    put them into the plans of this one."""
    if any("spark" in getattr(item, "fixturenames", ()) for item in request.session.items if item.path == request.path):
        request.getfixturevalue("spark").catalog.clearCache()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Rows as sorted tuples of the given columns (all when none)."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
