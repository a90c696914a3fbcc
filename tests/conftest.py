import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docpulse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, **{"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-")})
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")
