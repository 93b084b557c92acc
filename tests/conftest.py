import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", shuffle_partitions=8, app_name="tidewater-tests")
    yield session


@pytest.fixture()
def tmp(tmp_path_factory):
    return tempfile.mkdtemp(prefix="tw-", dir=str(tmp_path_factory.getbasetemp()))


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        fh.write(text)
    return path
