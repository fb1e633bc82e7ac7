import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from tessera.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir comes from the environment; get_session sets a
    # temporary one only when it is unset
    s = get_session("local[*]", app_name="tessera-tests", shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
