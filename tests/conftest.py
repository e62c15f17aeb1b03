import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wellspark.session import CHECKPOINT_CONF, build_session

    session = build_session("tests", "local[8]", 2)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get(CHECKPOINT_CONF, None):
        session.stop()
        session = build_session("tests", "local[8]", 2, {
            CHECKPOINT_CONF: str(tmp_path_factory.mktemp("shared"))})
        session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)
    return collect
