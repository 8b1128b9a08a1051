import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from roadlens.session import build_session
    shared = str(tmp_path_factory.mktemp("shared"))
    s = build_session("local[4]", 8, extra={"spark.checkpoint.dir": shared})
    yield s
    s.stop()


def rows(df, *cols):
    """Collect ``cols`` of a small test result as sorted tuples."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
