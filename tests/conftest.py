import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

#: Tests that need a database (embedded, in the Spark JVM, no port) run only when
#: TOLLGATE_TEST_DATABASE=1 says that one may be started.
needs_database = pytest.mark.skipif(
    os.environ.get("TOLLGATE_TEST_DATABASE") != "1", reason="starts an embedded database: set TOLLGATE_TEST_DATABASE=1"
)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tollgate.session import build_session

    s = build_session(
        "local[4]",
        app_name="tollgate-tests",
        shuffle_partitions=8,
        conf={"spark.ui.showConsoleProgress": "false"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_dir():
    # A fresh folder per test; never reused.
    return tempfile.mkdtemp(prefix="tollgate-test-")
