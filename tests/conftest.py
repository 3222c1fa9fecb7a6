import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from docketflow.session import build_session
    extra = {}
    if not os.environ.get("KEEP_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="docketflow-test-")
    s = build_session("local[4]", shuffle_partitions=8, app="docketflow-tests", extra=extra)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture(scope="session")
def cases(spark, sf_dir):
    from docketflow.sources.inputs import cases_for
    return cases_for(spark, sf_dir)
