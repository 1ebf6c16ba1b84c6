import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tillsight.session import build_session

    s = build_session("local[4]", 8, app_name="tillsight-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tillsight-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tillsight-test-")
