import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkcare.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="sparkcare-tests-")
    s = local_session(4, app="sparkcare-tests", memory="4g",
                      extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    yield s


@pytest.fixture
def tmp_out(tmp_path):
    return str(tmp_path)
