import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fareflow.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "fareflow-tests", "6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    from fareflow.plans.workspace import Workspace

    return Workspace(spark, SMALL)


@pytest.fixture(scope="session")
def medium(spark):
    from fareflow.plans.workspace import Workspace

    return Workspace(spark, MEDIUM)
