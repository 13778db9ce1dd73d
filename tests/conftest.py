import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from filingflow.session import build_session, work_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app_name="filingflow-tests")
    work_root(s)
    yield s
    s.stop()
