import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from wardwise.plans.views import Clinic  # noqa: E402
from wardwise.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "wardwise-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def clinic(spark):
    return Clinic(spark, FOLDER)


@pytest.fixture()
def frame(spark):
    """Small table from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
