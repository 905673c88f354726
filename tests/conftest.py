import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from setgraph.session import local_session
    s = local_session(4, shuffle_partitions=4, driver_memory="4g", app="setgraph-tests",
                      checkpoint=str(tmp_path_factory.mktemp("checkpoints")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted plain tuples of ``cols`` (all columns if none given)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
