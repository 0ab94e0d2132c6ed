import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from suite.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture
def texts(spark):
    def make(*values):
        return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, text string")

    return make
