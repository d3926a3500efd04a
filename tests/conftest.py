import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loadshift.session import get_session
    ckpt = tempfile.mkdtemp(prefix="loadshift-test-ckpt-")
    s = get_session("local[4]", app_name="loadshift-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt,
                           # a code-generation failure must fail the test, not fall back silently
                           "spark.sql.codegen.fallback": "false"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixture_dir(spark):
    import fixtures
    d = tempfile.mkdtemp(prefix="loadshift-fixture-")
    fixtures.write_all(d)
    return d


@pytest.fixture()
def out_dir():
    return tempfile.mkdtemp(prefix="loadshift-out-")
