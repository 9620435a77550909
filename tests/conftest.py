import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from learnsilver.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A small table from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
