import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session("local[4]", 4, extra={"spark.driver.memory": "6g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
